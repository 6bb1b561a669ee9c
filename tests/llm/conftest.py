import random

import public_tokenizers
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, size string, h string, words string"


@pytest.fixture(scope="session")
def byte_bpe():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def piece_bpe():
    return public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="session")
def edge_texts():
    """Nulls, empty and long texts, odd characters and random mixtures of them."""
    rng = random.Random(11)
    parts = ["a", "b", "'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "1", "2", "é", "ß", "!", "<|endoftext|>", "▁", "中"]
    parts += [" ", " ", "\x1c", "🙂", "'s", " '", "''", "word", " the", "The", "<s>", "<0x0A>", "\x00", "\r", "#$"]
    texts = [None, "", " ", "\n", "a", "A b", "x y z", "a" * 3000, "ab" * 2500, " " * 700, "<|endoftext|>", "<|endoftext|>" * 3]
    texts += ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    texts.append(" ".join(rng.choices(["alpha", "beta", "gamma,", "délta", "12", "don't"], k=300_000)))
    return texts


@pytest.fixture(scope="session")
def edge_docs(spark, edge_texts):
    """``edge_texts`` with a repeated row, a null id, and columns that operators also use."""
    rows = [(i, t, None, "s", 1, "r", "z", "h", "w") for i, t in enumerate(edge_texts)]
    rows += [rows[7], (None, "the null id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
