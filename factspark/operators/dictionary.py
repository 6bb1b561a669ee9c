"""Phrase dictionaries: rows of ``label, canonical, alias, toks, n``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.functions.strings import split_strip, strip, words
from factspark.session import literal_table

# The medical phrases every dictionary holds.
STATIC_PATTERNS = [
    ("DISEASE", "Hypertrophic Cardiomyopathy", "hypertrophic cardiomyopathy"),
    ("DISEASE", "Hypertrophic Cardiomyopathy", "hcm"),
    ("DISEASE", "Polycystic Kidney Disease", "polycystic kidney disease"),
    ("SYMPTOM", "Lethargy", "lethargy"),
    ("SYMPTOM", "Vomiting", "vomiting"),
]


def _with_tokens(patterns: DataFrame) -> DataFrame:
    return patterns.withColumn("toks", words(F.lower("alias"))).withColumn(
        "n", F.size("toks").cast("int")
    )


def name_lines(breeds: DataFrame) -> DataFrame:
    """One line per record, the name and its alternatives: ``Name, alt1, alt2``."""
    return breeds.select(F.concat_ws(", ", "name", "alt_names").alias("line"))


def payload_lines(envelopes: DataFrame) -> DataFrame:
    """The lines of text envelopes, empty ones included."""
    return envelopes.select(F.explode(F.split("payload", "\n")).alias("line"))


def usable_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not blank and whose first comma-separated part is not blank."""
    first_part = strip(F.element_at(F.split("line", ","), 1))
    return lines.filter((strip(F.col("line")) != "") & (first_part != ""))


def build_dictionary(lines: DataFrame, label: str) -> DataFrame:
    """One row per line and distinct non-blank part; the first part is canonical."""
    parts = split_strip(F.col("line"), ",")
    aliases = F.array_distinct(F.filter("parts", lambda part: part != ""))
    return _with_tokens(
        usable_lines(lines)
        .select(parts.alias("parts"))
        .select(
            F.lit(label).alias("label"),
            F.element_at("parts", 1).alias("canonical"),
            F.explode(aliases).alias("alias"),
        )
    )


def patterns(spark: SparkSession, rows: list[tuple[str, str | None, str]]) -> DataFrame:
    """A dictionary from literal ``(label, canonical, alias)`` rows."""
    return _with_tokens(
        literal_table(spark, rows, "label string, canonical string, alias string")
    )


def static_patterns(spark: SparkSession) -> DataFrame:
    return patterns(spark, STATIC_PATTERNS)


def all_patterns(entities: DataFrame, *more: DataFrame) -> DataFrame:
    """Entity names and further patterns as one dictionary."""
    for other in more:
        entities = entities.unionByName(other)
    return entities
