"""Fact strings to candidate fact rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factspark.functions.paths import UNKNOWN_SOURCE, path_source
from factspark.functions.strings import (
    after_first,
    array_where,
    before_first,
    let,
    split_strip,
    strip,
    tag,
    title_case,
)
from factspark.operators.dedup import keep_first

CANDIDATE_COLUMNS = ["breed", "fact_type", "fact_value", "source", "hdfs_path"]


def has_text(c: Column) -> Column:
    """Neither NULL nor empty."""
    return c.isNotNull() & (c != "")


def structured_facts(breeds: DataFrame, source_file: str | Column) -> DataFrame:
    """Records to ``title, source_file, extracted_facts``, facts in field order, repeats kept."""
    name, origin, temperament = F.col("name"), F.col("origin"), F.col("temperament")
    single = array_where(
        (has_text(name), tag("BREED", name)), (has_text(origin), tag("ORIGIN", origin))
    )
    traits = F.when(
        has_text(temperament),
        F.transform(split_strip(temperament, ", "), lambda t: tag("CHARACTER", t)),
    ).otherwise(F.array().cast("array<string>"))
    path = F.lit(source_file) if isinstance(source_file, str) else source_file
    return breeds.select(
        name.alias("title"),
        path.alias("source_file"),
        F.concat(single, traits).alias("extracted_facts"),
    )


def entity_of_doc(facts: Column, label: str = "BREED") -> Column:
    """The value of the first fact with the label (case counts); NULL where there is none.

    A blank first value is returned as it is: later ones are not looked at.
    """
    first = F.get(F.filter(facts, lambda f: f.startswith(f"{label}:")), F.lit(0))
    return strip(after_first(first, ":"))


def parse_facts(df: DataFrame, fact: str = "fact", entity_label: str = "BREED") -> DataFrame:
    """Add ``fact_type, fact_value`` and drop what is not a usable fact.

    ``TAG:value`` is type ``tag``; ``FEATURE:k=v`` is type ``feature_k`` with value
    ``v``. Dropped: no colon, the entity label in any case, an empty value. An empty
    tag stays.
    """
    parts = F.struct(
        F.upper(strip(before_first(F.col(fact), ":"))).alias("prefix"),
        strip(after_first(F.col(fact), ":")).alias("value"),
    )

    def parsed(p: Column) -> Column:
        keyed = (p["prefix"] == "FEATURE") & p["value"].contains("=")
        kind = F.when(
            keyed, F.concat(F.lit("feature_"), F.lower(strip(before_first(p["value"], "="))))
        ).otherwise(F.lower(p["prefix"]))
        value = F.when(keyed, strip(after_first(p["value"], "="))).otherwise(p["value"])
        return F.struct(
            p["prefix"].alias("prefix"), kind.alias("fact_type"), value.alias("fact_value")
        )

    # One row or none of each fact: a filter on columns would compute them once more.
    usable = F.filter(
        F.array(let(parts, parsed)),
        lambda f: (f["prefix"] != entity_label) & (f["fact_value"] != ""),
    )
    kept = F.when(F.col(fact).contains(":"), usable)
    return df.select("*", F.explode(kept).alias("_parsed")).select(
        *df.columns, "_parsed.fact_type", "_parsed.fact_value"
    )


def document_entities(docs: DataFrame, entity_label: str = "BREED") -> DataFrame:
    """Documents that name an entity, as ``breed, source, hdfs_path, extracted_facts``."""
    explicit = F.col("source") if "source" in docs.columns else None
    entity = entity_of_doc(F.col("extracted_facts"), entity_label)
    named = F.filter(F.array(entity), lambda e: F.length(e) > 0)  # computed once, one or none
    return docs.select("*", F.explode(named).alias("breed")).select(
        "breed",
        path_source(F.col("source_file"), explicit).alias("source"),
        F.col("source_file").alias("hdfs_path"),
        "extracted_facts",
    )


def candidate_facts(docs: DataFrame, entity_label: str = "BREED") -> DataFrame:
    """Documents with their facts to distinct candidate rows.

    ``docs``: ``source_file, extracted_facts`` and, when present, ``source``. Repeats
    within a document go before the shuffle; the path in the key spreads frequent facts.
    """
    entities = document_entities(docs, entity_label)
    facts = entities.select(
        "breed", "source", "hdfs_path", F.explode(F.array_distinct("extracted_facts")).alias("fact")
    )
    return (
        parse_facts(facts, "fact", entity_label)
        .select(*CANDIDATE_COLUMNS)
        .dropDuplicates(CANDIDATE_COLUMNS)
    )


def normalize_columns(candidates: DataFrame) -> DataFrame:
    """Strip and set the case of each column; a missing source is ``unknown``."""
    return candidates.na.drop(subset=["breed", "fact_type", "fact_value"]).withColumns(
        {
            "breed": title_case(strip(F.col("breed"))),
            "fact_type": F.upper(strip(F.col("fact_type"))),
            "fact_value": F.lower(strip(F.col("fact_value"))),
            "source": F.coalesce(F.lower(strip(F.col("source"))), F.lit(UNKNOWN_SOURCE)),
        }
    )


def normalize_candidates(candidates: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Normalised candidates, the first row by ``order_by`` for each fact and source."""
    keys = ["breed", "fact_type", "fact_value", "source"]
    return keep_first(normalize_columns(candidates), keys, order_by)
