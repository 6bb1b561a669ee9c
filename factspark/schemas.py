"""Declared schemas of the records read and the tables written."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


BREED = StructType(_strings("name", "alt_names", "origin", "temperament"))

BREEDS_RAW = StructType(
    _strings("url", "fetched_at", "content_type") + [StructField("payload", ArrayType(BREED))]
)

# Search responses and single articles fetched from an API; payload is XML text.
API_RAW = StructType(_strings("url", "fetched_at", "content_type", "payload"))

PAGE_RAW = StructType(_strings("title", "content", "timestamp", "url"))

# Both record shapes at once, for a mixed read.
ARTICLE_RAW = StructType(
    _strings("title", "content", "timestamp", "url", "fetched_at", "content_type", "payload")
)

NAMES_RAW = StructType(
    _strings("source", "generated_at", "content_type", "payload")
    + [StructField("record_no", LongType()), StructField("n_lines", LongType())]
)

EXTRACTED = StructType(
    _strings("title", "source_file")
    + [StructField("extracted_facts", ArrayType(StringType()))]
    + _strings("source")
)

CANDIDATE_FACTS = StructType(
    [
        StructField("breed", StringType(), False),
        StructField("fact_type", StringType(), False),
        StructField("fact_value", StringType(), False),
        StructField("source", StringType()),
        StructField("hdfs_path", StringType()),
    ]
)

SOURCE_WEIGHTS = StructType(
    [StructField("source", StringType(), False), StructField("weight", DoubleType())]
)

FINAL_FACTS = StructType(
    [
        StructField("breed", StringType(), False),
        StructField("fact_type", StringType(), False),
        StructField("fact_value", StringType(), False),
        StructField("mentions_count", LongType(), False),
        StructField("sources_count", LongType(), False),
        StructField("source_list", StringType()),
        StructField("final_score", DoubleType()),
    ]
)

_ID = StructField("id", LongType(), False)

# The three tables of the fact store, with their surrogate ids.
TABLES = {
    "candidate_facts": StructType([_ID, *CANDIDATE_FACTS.fields]),
    "source_weights": SOURCE_WEIGHTS,
    "final_facts": StructType([_ID, *FINAL_FACTS.fields]),
}

# What the tables require of their rows; `quality.py` checks it.
REQUIRED = {
    "candidate_facts": ["breed", "fact_type", "fact_value"],
    "source_weights": ["source"],
    "final_facts": ["breed", "fact_type", "fact_value", "mentions_count", "sources_count"],
}
UNIQUE = {
    "source_weights": ["source"],
    "final_facts": ["breed", "fact_type", "fact_value"],
}

# Data embedded in a listing page.
_LINKS = ArrayType(StructType(_strings("url")))
LISTING_DATA = StructType(
    [
        StructField(
            "props",
            StructType(
                [
                    StructField(
                        "pageProps",
                        StructType(
                            [
                                StructField(
                                    "data",
                                    StructType(
                                        [StructField("result", _LINKS), StructField("items", _LINKS)]
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        )
    ]
)

# A member of a page category; ns is the namespace number.
MEMBERS_RAW = StructType(
    [
        StructField("title", StringType()),
        StructField("ns", IntegerType()),
        StructField("content", StringType()),
    ]
)
