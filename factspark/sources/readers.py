"""Read records and tables, and bring documents of several shapes into one form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TEXT_COLUMNS = ("content", "payload")


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str,
              multiline: bool = False, recursive: bool = False,
              provenance: str | None = None) -> DataFrame:
    """JSON records from paths or globs, as one table with the declared columns.

    A record that lacks a column has NULL there. ``multiline``: one record per file, or a
    list of records, printed over several lines; such files are not split. ``recursive``: all ``.json``
    files below a folder, files that vanish meanwhile are skipped. ``provenance``
    names a column for the file path.
    """
    reader = spark.read.schema(schema).option("multiLine", multiline)
    if recursive:
        reader = (
            reader.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.json")
            .option("ignoreMissingFiles", True)
        )
    df = reader.json([paths] if isinstance(paths, str) else list(paths))
    return df if provenance is None else with_provenance(df, provenance)


def read_parquet(spark: SparkSession, path: str, provenance: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if provenance is None else with_provenance(df, provenance)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A whole table of the session's catalog."""
    return spark.table(table)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A whole table of a database; give ``partitionColumn`` and bounds for large ones."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def with_provenance(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the path of the file a row was read from (a blank in it reads ``%20``)."""
    return df.select("*", F.col("_metadata.file_path").alias(column))


def require_columns(df: DataFrame, all_of: Sequence[str] = (),
                    any_of: Sequence[str] = ()) -> DataFrame:
    """``df`` itself, or a clear error when columns are missing."""
    missing = [c for c in all_of if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    if any_of and not any(c in df.columns for c in any_of):
        raise ValueError(f"the input has none of the columns {list(any_of)}")
    return df


def unify_text(df: DataFrame, candidates: Sequence[str] = TEXT_COLUMNS,
               column: str = "text") -> DataFrame:
    """One text column from those of ``candidates`` the table has, the first present wins."""
    require_columns(df, any_of=candidates)
    present = [c for c in candidates if c in df.columns]
    return df.withColumn(column, F.coalesce(*[F.col(c) for c in present])).drop(
        *[c for c in present if c != column]
    )


def title_or_url(df: DataFrame, row_level: bool = False) -> DataFrame:
    """Where the table has no title column, the URL is the title.

    In a mixed table records without a title keep NULL, unless ``row_level`` is set.
    """
    if "title" not in df.columns:
        return df.withColumn("title", F.col("url"))
    return df.withColumn("title", F.coalesce("title", "url")) if row_level else df


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """Tables of different record shapes as one; a column a table lacks is NULL."""
    first, *others = corpora
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def flatten_payload(df: DataFrame, column: str = "payload") -> DataFrame:
    """One row per element of an array of records; missing and empty arrays drop out."""
    return df.select(F.explode(column).alias("_record")).select("_record.*")


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    """Add the time of the run and the input's name."""
    return df.withColumns({"generated_at": F.current_timestamp(), "source": F.lit(source)})


def flatten_breeds(raw: DataFrame, source: str) -> DataFrame:
    """Fetched record lists to a flat table with lineage."""
    return with_lineage(flatten_payload(raw), source)
