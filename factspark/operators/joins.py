"""Joins of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side up to this size goes to every executor whole.
BROADCAST_BYTES = 64 << 20
SALTS = 32


def size_in_bytes(df: DataFrame) -> int:
    """The size of a table as JSON text; one distributed aggregate, one row back."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return size_in_bytes(df) <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "inner",
    spread_by: list[str] | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join a large table (left) with a lookup table (right), ``inner`` or ``left``.

    The lookup side is broadcast when its measured size allows. Else both sides are
    shuffled with a salt next to the key, so that a key holding a large part of all
    rows spreads over several tasks; the lookup side is repeated once per salt.
    ``spread_by`` names columns that tell the rows of one key apart. ``small`` gives
    the outcome of an earlier size check.
    """
    if fits_broadcast(lookup) if small is None else small:
        return large.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(*(spread_by or large.columns)), F.lit(SALTS)).cast("int")
    salted = large.withColumn("_salt", salt)
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
