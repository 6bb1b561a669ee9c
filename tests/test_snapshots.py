"""Tables published by manifests."""

import pytest
from pyspark.sql import functions as F

from factspark.session import fresh_path
from factspark.sources import snapshots as S


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_readers_see_old_or_new_rows_at_every_step(spark, monkeypatch):
    root = fresh_path(spark, "table")
    assert S.pin(spark, root) is None
    old = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    first = S.publish_rows(old, root)
    seen = []
    real = {name: getattr(S, name) for name in ("_numbers", "new_folder", "publish")}

    def watched(name):
        def call(*args, **kwargs):
            seen.append(rows(spark.read.schema("id int, name string").parquet(*first.paths())))
            monkeypatch.setattr(S, "_numbers", real["_numbers"])
            seen.append(rows(S.read_rows(spark, root)))
            return real[name](*args, **kwargs)

        return call

    for name in ("new_folder", "publish"):
        monkeypatch.setattr(S, name, watched(name))
    broken = spark.range(3).select(F.col("id").cast("int"), F.raise_error(F.lit("lost")).alias("name"))
    with pytest.raises(Exception, match="lost"):
        S.publish_rows(broken, root)
    new = spark.createDataFrame([(3, "c")], "id int, name string")
    second = S.publish_rows(new, root)
    assert len(seen) == 6 and all(s == rows(old) for s in seen)
    monkeypatch.undo()
    assert rows(S.read_rows(spark, root)) == [(3, "c")]
    assert rows(S.read_rows(spark, first)) == rows(old)
    assert rows(S.read_rows(spark, S.pin(spark, root, first.number))) == rows(old)
    # The folder of the failed refresh and that of the first snapshot go.
    assert S.expire(spark, root, keep=1) == 2
    assert rows(S.read_rows(spark, second)) == [(3, "c")]
    with pytest.raises(ValueError, match="no snapshot"):
        S.pin(spark, root, first.number)


def test_a_manifest_that_cannot_be_moved_changes_nothing(spark):
    root = fresh_path(spark, "table")
    before = S.publish_rows(spark.range(2), root)
    S.publish_rows(spark.range(5), root)
    with pytest.raises(S.Conflict):
        S.publish(spark, root, list(before.folders), before.properties, before)
    with pytest.raises(S.Conflict):
        S.publish(spark, root, list(before.folders), before.properties)
    assert S.read_rows(spark, root).count() == 5


def test_a_table_may_be_replaced_by_what_it_holds_and_grow(spark):
    root = fresh_path(spark, "table")
    S.append_rows(spark.range(4).withColumn("x", F.lit(None).cast("string")), root)
    S.publish_rows(S.read_rows(spark, root).filter("id > 1"), root)
    more = S.append_rows(spark.range(9, 10).select(F.lit("y").alias("x"), "id"), root)
    assert rows(S.read_rows(spark, more)) == [(2, None), (3, None), (9, "y")]
    S.publish_rows(S.read_rows(spark, root).filter("id < 0"), root)
    assert S.read_rows(spark, root).columns == ["id", "x"] and S.read_rows(spark, root).isEmpty()
