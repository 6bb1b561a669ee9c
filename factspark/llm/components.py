"""Connected components by contraction, with no step that gathers a component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factspark.session import fresh_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder, so that later steps read fixed rows."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` for every node of ``links`` (``a``, ``b``: two longs).

    The label is one of the component's nodes. In each round every node takes its
    smallest neighbour as parent, parents are followed one step further, and the links
    are drawn between the parents; a component is done when it has no link left. Loops
    and repeated links are harmless; no links give no rows.
    """
    links = stored(_clean(links.select("a", "b")), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("b"))
        parent = parent.select(F.col("a").alias("node"), F.least("a", "b").alias("parent"))
        parent = stored(parent, "parents")
        further = parent.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        parent = stored(parent.join(further, "parent").select("node", F.col("next").alias("parent")), "parents")
        if labels is None:
            labels = parent.withColumnRenamed("parent", "label")
        else:
            step = parent.select(F.col("node").alias("label"), "parent")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
        labels = stored(labels, "labels")
        ends = [parent.select(F.col("node").alias(x), F.col("parent").alias(f"to_{x}")) for x in ("a", "b")]
        links = links.join(ends[0], "a").join(ends[1], "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        links = stored(_clean(links), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _clean(links: DataFrame) -> DataFrame:
    return links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
