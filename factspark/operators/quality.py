"""Checks a table's rows must pass before they are published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.schemas import REQUIRED, UNIQUE


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many rows lack each column; one pass, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_valid(df: DataFrame, table: str) -> DataFrame:
    """``df`` itself, after checking the table's required columns and unique key."""
    missing = null_counts(df, REQUIRED[table]).first().asDict()
    broken = {column: n for column, n in missing.items() if n}
    if broken:
        raise ValueError(f"{table}: NULL in required columns: {broken}")
    if table in UNIQUE and not duplicate_keys(df, UNIQUE[table]).isEmpty():
        raise ValueError(f"{table}: rows repeat the key {UNIQUE[table]}")
    return df
