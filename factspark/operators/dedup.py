"""Removing duplicates with a stated choice of the row that stays.

All of these aggregate before the shuffle, so a key with very many copies arrives as
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order_by``, which should be a total order."""
    return _pick(df, keys, F.min_by(F.struct(*df.columns), F.struct(*order_by)))


def last_write_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``, which should be a total order."""
    return _pick(df, keys, F.max_by(F.struct(*df.columns), F.struct(*order_by)))


def _pick(df: DataFrame, keys: Sequence[str], chosen) -> DataFrame:
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        chosen.alias("row")
    ).select("row.*")
