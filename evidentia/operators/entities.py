"""Entities from facts: names, types, aliases, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions import text as T


def build_entities(facts: DataFrame, normalise: bool = True) -> DataFrame:
    """One entity for each canonical name and type; source and confidence are those of its first mention (fact id, subject first).

    Aliases are all spellings of the canonical name, whatever the type, and the configured ones.
    """
    sides = F.array(
        F.struct(F.col("subject").alias("raw"), F.col("subject_type").alias("type"), F.lit(0).alias("side"), F.when(F.col("predicate") == "located_in", T.entity_name(F.col("object"), normalise)).alias("place")),
        F.struct(F.col("object").alias("raw"), F.col("object_type").alias("type"), F.lit(1).alias("side"), F.when((F.col("predicate") == "located_in") & (F.col("object") == F.col("subject")), T.entity_name(F.col("object"), normalise)).alias("place")),
    )
    mentions = facts.select("fact_id", "evidence_source_id", "confidence", F.explode(sides).alias("m")).select("fact_id", "evidence_source_id", "confidence", "m.*")
    mentions = mentions.withColumn("name", T.entity_name(F.col("raw"), normalise))
    regions = F.array_sort(F.array_union(F.collect_set("place"), F.collect_set(F.when(F.col("type") == "REGION", F.col("name")))))
    first = F.min_by(F.struct("evidence_source_id", "confidence"), F.struct("fact_id", "side"))
    grouped = mentions.groupBy("name", "type").agg(regions.alias("regions"), first.alias("first"))
    inverse: dict[str, list[str]] = {}
    for alias, canonical in T.ENTITY_ALIASES.items():
        inverse.setdefault(canonical, []).append(alias)
    configured = F.create_map(*(x for k, v in inverse.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    spelled = mentions.groupBy("name").agg(F.collect_set("raw").alias("spellings"))
    both = grouped.join(spelled, "name")
    aliases = F.array_sort(F.array_except(F.array_union("spellings", F.coalesce(F.try_element_at(configured, F.col("name")), F.array().cast("array<string>"))), F.array("name")))
    return both.select(ids.entity_id(F.col("type"), F.col("name")).alias("entity_id"), "name", "type", aliases.alias("aliases"), "regions", F.col("first.evidence_source_id").alias("canonical_source_id"), F.col("first.confidence").alias("confidence"))


def alias_map(entities: DataFrame, normalise: bool = True) -> DataFrame:
    """``(alias_key, name)``: of entities that share an alias the last by name and type has it."""
    rows = entities.select(F.explode("aliases").alias("alias"), "name", "type")
    return rows.groupBy(T.text_key(F.col("alias"), normalise).alias("alias_key")).agg(F.max_by("name", F.struct("name", "type", "alias")).alias("name"))
