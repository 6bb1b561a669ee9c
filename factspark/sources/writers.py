"""Write tables: whole replacements, envelopes, dense ids, checks on the way."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from factspark.operators.quality import assert_valid
from factspark.schemas import TABLES
from factspark.session import cut_lineage

# Characters of records that one file of a pretty-printed list holds.
LIST_CHARACTERS = 4 << 20


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    """JSON lines; NULL fields are left out, empty arrays stay."""
    df.write.mode("overwrite").json(path)


def write_json_lists(df: DataFrame, path: str, characters: int = LIST_CHARACTERS) -> None:
    """Pretty-printed JSON, in each file a list of records over several lines.

    The number of files grows with the size of the records, not with their number. A file
    that ``characters`` do not hold has one record; no task keeps more than a file and a batch.
    """

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0):
                record = value.as_py()
                if held and size + len(record) > characters:
                    yield joined(held)
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield joined(held)

    def joined(records: list[str]) -> pa.RecordBatch:
        return pa.record_batch({"value": pa.array(["[\n" + ",\n".join(records) + "\n]"], pa.string())})

    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true"})
    texts = df.select(record.alias("value")).mapInArrow(lists, "value string")
    texts.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)


def write_counted(df: DataFrame, path: str, preview: int = 0) -> tuple[int, list]:
    """Replace a Parquet folder and return the row count, and the first rows stored.

    The count rides on the write and the preview reads what was written, so the plan
    runs once.
    """
    seen = Observation()
    overwrite_parquet(df.observe(seen, F.count("*").alias("rows")), path)
    rows = df.sparkSession.read.parquet(path).limit(preview).collect() if preview else []
    return seen.get["rows"], rows


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """The first rows by an order; each task keeps its own first ``n``."""
    return df.orderBy(*order_by).limit(n)


def replace_folder(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder; its readers never see a mixture of old and new rows.

    Rows are written next to the target and moved in place by renaming; a task that
    is retried leaves nothing behind. Between the two renames a reader can find no
    folder. If the second one fails, the old folder goes back to its place.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    staged, old = f"{path}.staged-{mark}", f"{path}.old-{mark}"
    df.write.parquet(staged)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    _swap(fs, target, hadoop.Path(staged), hadoop.Path(old))


def _swap(fs, target, staged, old) -> None:
    """Move ``staged`` to ``target`` and remove what was there, or leave it as it was."""
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"cannot move {target} to {old}")
    moved = False
    try:
        moved = fs.rename(staged, target)
    finally:
        if not moved and replaced and not fs.rename(old, target):
            raise OSError(f"the old rows of {target} are left in {old}")
    if not moved:
        raise OSError(f"cannot move {staged} to {target}")
    if replaced:
        fs.delete(old, True)


def replace_jdbc_table(df: DataFrame, url: str, table: str, batch_size: int = 10_000,
                       **options: str) -> None:
    """Empty a database table and insert the rows by partition, in batches."""
    df.write.mode("overwrite").format("jdbc").options(
        url=url, dbtable=table, truncate="true", batchsize=str(batch_size), **options
    ).save()


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Create the three tables of the fact store where they are missing."""
    for name, schema in TABLES.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema.toDDL()}) USING parquet"
        )


def refresh_table(df: DataFrame, table: str, schema_of: str | None = None,
                  order_by: Sequence[str] = ()) -> None:
    """Replace a table's rows after checking them; ids restart from 1 in ``order_by``.

    The rows are computed once, stored, checked and then moved into the table.
    """
    name = schema_of or table.split(".")[-1]
    columns = TABLES[name].fieldNames()
    if "id" in columns:
        df = dense_ids(df, order_by, "id")
    else:
        df = cut_lineage(df)
    assert_valid(df, name).select(*columns).write.insertInto(table, overwrite=True)


def dense_ids(df: DataFrame, order_by: Sequence[str | Column], column: str = "id") -> DataFrame:
    """Number the rows from 1 in an order, without gaps and without one task for all rows.

    Rows are sorted by range, numbered within each task, and shifted by the number of
    rows in the tasks before. The sorted rows are stored first: a range sort picks its
    bounds by sampling, so counting and numbering must read the same rows. Equal rows
    spread over tasks by their place in the input, which is stored too: were a lost
    task to number its rows anew, rows could move between ranges.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    placed = cut_lineage(df).withColumn("_place", F.monotonically_increasing_id())
    stored = cut_lineage(
        placed.repartitionByRange(*order, "_place")
        .sortWithinPartitions(*order, "_place")
        .withColumns({"_task": F.spark_partition_id(), "_local": F.monotonically_increasing_id()})
    )
    in_task = F.col("_local") - F.shiftleft(F.col("_task").cast("bigint"), 33)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_task")
        .agg(F.count("*").alias("_n"))  # one row per task
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_task", "_offset")
    )
    return (
        stored.withColumn("_at", in_task)
        .join(F.broadcast(offsets), "_task")
        .select((F.col("_offset") + F.col("_at") + 1).alias(column), *df.columns)
    )


def text_payloads(lines: DataFrame, per_record: int) -> DataFrame:
    """Lines in order, joined by line breaks into records of ``per_record`` lines.

    ``record_no, n_lines, payload``: the numbers, from 0, put the records in order, and
    only the last one may have fewer lines. No task ever holds all lines.
    """
    numbered = dense_ids(lines.select("line"), ["line"], "_id")
    record = F.floor((F.col("_id") - 1) / per_record).cast("bigint")
    return (
        numbered.withColumn("record_no", record)
        .groupBy("record_no")
        .agg(F.array_sort(F.collect_list(F.struct("_id", "line"))).alias("_lines"))
        .select(
            "record_no",
            F.size("_lines").cast("bigint").alias("n_lines"),
            F.array_join(F.col("_lines.line"), "\n").alias("payload"),
        )
    )


def text_envelopes(lines: DataFrame, source: str, per_record: int) -> DataFrame:
    """Records of joined lines with their place, their source and the time of the run."""
    return text_payloads(lines, per_record).select(
        F.lit(source).alias("source"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
        F.lit("txt").alias("content_type"),
        "record_no",
        "n_lines",
        "payload",
    )


def write_text_envelopes(lines: DataFrame, path: str, source: str, per_record: int) -> None:
    records = text_envelopes(lines, source, per_record)
    record = F.to_json(F.struct(*records.columns))
    records.select(record.alias("value")).write.mode("overwrite").text(path)
