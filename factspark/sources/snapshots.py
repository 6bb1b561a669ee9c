"""Tables published by manifests: readers see the old rows or the new rows, never a part.

A table is a folder. Rows are written to new folders in it (or in a part of it, a folder
below it, where a table has rows of several kinds) and count only once a
manifest, a small numbered JSON file, lists them. A refresh publishes by moving one
complete manifest to a name that is not taken yet; a reader pins the manifest with the
highest number and reads exactly the folders in it, whatever is published meanwhile.
A refresh that fails before that leaves folders no manifest lists (``expire`` removes them).

A move onto a taken name fails on file systems such as HDFS, so of two refreshes that
began from one snapshot the second one gets an error. A file system whose move replaces
its target (local disks, some object stores) is asked for the name just before.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MANIFESTS = "_manifests"


class Conflict(RuntimeError):
    """Another refresh has published since the snapshot that this one began from."""


@dataclass(frozen=True)
class Snapshot:
    """A pinned state of a table: its number, folders in order, and free properties."""

    root: str
    number: int
    folders: tuple[str, ...]
    properties: dict = field(default_factory=dict, compare=False)

    def paths(self, part: str = "") -> list[str]:
        """Where the folders lie: all, or those in the folder ``part`` of the table."""
        return [f"{self.root}/{f}" for f in self.folders if not part or f.startswith(f"{part}/")]


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _manifest(number: int) -> str:
    return f"{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, path = _files(spark, root)
    folder = path(f"{root}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, root: str, number: int) -> Snapshot:
    fs, path = _files(spark, root)
    stream = fs.open(path(f"{root}/{MANIFESTS}/{_manifest(number)}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    stored = json.loads(text)
    return Snapshot(root, number, tuple(stored["folders"]), stored["properties"])


def pin(spark: SparkSession, root: str, number: int | None = None) -> Snapshot | None:
    """The newest snapshot, or the one of a number; None where nothing is published."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if number is not None and number not in numbers:
        raise ValueError(f"{root} has no snapshot {number}")
    return _load(spark, root, numbers[-1] if number is None else number) if numbers else None


def new_folder(prefix: str = "rows") -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folders: list[str], properties: dict | None = None,
            after: Snapshot | None = None) -> Snapshot:
    """Make ``folders`` the table's content, if ``after`` is still its newest snapshot."""
    root = root.rstrip("/")
    number = after.number + 1 if after else 1
    fs, path = _files(spark, root)
    target = path(f"{root}/{MANIFESTS}/{_manifest(number)}")
    staged = path(f"{root}/{MANIFESTS}/.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(target.getParent())
    stream = fs.create(staged, False)
    try:
        stream.write(json.dumps({"folders": folders, "properties": properties or {}}).encode())
    finally:
        stream.close()
    newest = (_numbers(spark, root) or [0])[-1]
    if newest >= number or not fs.rename(staged, target):
        fs.delete(staged, False)
        raise Conflict(f"{root} is at snapshot {newest}, not at {number - 1}")
    return Snapshot(root, number, tuple(folders), properties or {})


def publish_rows(df: DataFrame, root: str) -> Snapshot:
    """Replace a table's rows. ``df`` may read the table itself."""
    spark, root = df.sparkSession, root.rstrip("/")
    before = pin(spark, root)
    folder = new_folder()
    df.write.parquet(f"{root}/{folder}")
    return publish(spark, root, [folder], {"schema": df.schema.json()}, before)


def append_rows(df: DataFrame, root: str) -> Snapshot:
    """Add rows to a table, whose columns they must have."""
    spark, root = df.sparkSession, root.rstrip("/")
    before = pin(spark, root)
    if before is None:
        return publish_rows(df, root)
    schema = StructType.fromJson(json.loads(before.properties["schema"]))
    folder = new_folder()
    df.select(*[df[f.name].cast(f.dataType) for f in schema]).write.parquet(f"{root}/{folder}")
    return publish(spark, root, [*before.folders, folder], before.properties, before)


def read_rows(spark: SparkSession, at: Snapshot | str) -> DataFrame:
    """The rows of a pinned snapshot, or of a table's newest one."""
    snapshot = pin(spark, at) if isinstance(at, str) else at
    if snapshot is None:
        raise ValueError(f"nothing is published in {at}")
    schema = StructType.fromJson(json.loads(snapshot.properties["schema"]))
    return spark.read.schema(schema).parquet(*snapshot.paths())


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all but the newest ``keep`` manifests, then the folders that none lists.

    Run it while no refresh is under way, as folders not yet published go too, and when
    nobody reads snapshots older than those kept. Returns the number of folders removed.
    """
    if keep < 1:
        raise ValueError("the newest snapshot stays")
    root = root.rstrip("/")
    fs, path = _files(spark, root)
    numbers = _numbers(spark, root)
    held = {f for n in numbers[-keep:] for f in _load(spark, root, n).folders}
    for n in numbers[:-keep]:
        fs.delete(path(f"{root}/{MANIFESTS}/{_manifest(n)}"), False)
    parts = {f.split("/")[0] for f in held if "/" in f}

    def inside(folder: str) -> list[str]:
        return [s.getPath().getName() for s in fs.listStatus(path(folder)) if s.isDirectory()]

    names = [n for n in inside(root) if n != MANIFESTS and n not in parts]
    names += [f"{part}/{n}" for part in sorted(parts) for n in inside(f"{root}/{part}")]
    spare = [n for n in names if n not in held]
    for name in spare:
        fs.delete(path(f"{root}/{name}"), True)
    return len(spare)
