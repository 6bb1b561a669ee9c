"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def build_session(app_name: str = "factspark", **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; ``conf`` overrides them.

    The number of shuffle partitions is left to the cluster: adaptive execution
    merges small ones, so a large initial number costs little.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of fixed rows, kept in the plan itself so that reading it costs no job."""
    fields = StructType.fromDDL(schema).fieldNames()
    columns = {name: [row[i] for row in rows] for i, name in enumerate(fields)}
    return spark.createDataFrame(pa.table(columns), schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Where the session names none, a temporary folder is made in local mode only:
    on a cluster a machine-local folder would lose data with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="factspark-"))
    return spark.sparkContext.getCheckpointDir()


_made: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_stored(spark: SparkSession) -> int:
    """Remove what this process wrote under fresh paths, and return how many there were.

    Call it when no result that reads them is needed any more. Checkpoints are Spark's:
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` has them removed with the
    DataFrames that hold them.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    removed = 0
    while _made:
        path = hadoop.Path(_made.pop())
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        removed += bool(fs.delete(path, True))
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so later steps read fixed rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
