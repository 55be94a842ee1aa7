"""The dataset report: all counts, distributions and audits of a release from one scan of each table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.urls import in_domains
from evidentia.plans.shared import written


def tally(table: DataFrame, counters: dict[str, Column | None], lists: dict[str, Column] | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """``(section, key, n)`` in one scan: rows by the value of each counter (None: all rows; null values aren't counted), by each item
    of the lists, and sums. Rows give one small record for each section, which are combined before the shuffle."""
    record = lambda section, key, n: F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"), n.cast("long").alias("n"))
    one = [record(s, F.lit("") if c is None else c, F.lit(1)) for s, c in counters.items()]
    one += [record(s, F.lit(""), F.coalesce(c, F.lit(0))) for s, c in (sums or {}).items()]
    items = lambda section, c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: record(section, x, F.lit(1)))
    many = [items(section, c) for section, c in (lists or {}).items()]
    return table.select(F.inline(F.concat(F.array(*one), *many))).filter("key is not null").groupBy("section", "key").agg(F.sum("n").alias("n"))


def dataset_report(sources: DataFrame, entities: DataFrame, facts: DataFrame, chunks: DataFrame, questions: DataFrame, restricted_domains: list[str] = ()) -> DataFrame:
    """``(section, key, value)``: the whole report. Each table is scanned once; everything else comes from the tallies, written once.

    ``counts``; distributions ``source_type, release_policy, topic, region, entity_type, relation, chunk_kind, answer_type``; ``facts``, ``chunks``
    and ``qa`` (verified, lengths, unanswerable); ``average_per_source`` and, for each registered source, zeros included, ``source_facts``,
    ``source_chunks`` and ``source_qa``; ``restricted_audit`` (``passed`` is 1 or 0). Links to unregistered sources count in averages and
    counts only. Columns of ``sources``: source_id, source_type, license_status, release_policy, domain, topic, region; of ``entities``: type; of ``facts``:
    predicate, evidence_source_id, verified, manual_checked; of ``chunks``: source_id, chunk_kind, text; of ``questions``: answer_type, unanswerable,
    manual_checked, evidence_source_ids. A source that is there twice counts twice. Empty tables give zeros.
    """
    yes = lambda c: F.when(F.col(c), F.lit("yes"))
    closed = F.col("license_status").isin("restricted", "forbidden") | F.col("release_policy").isin("local_only", "exclude", "metadata_and_facts_only") | in_domains(F.col("domain"), list(restricted_domains))
    length = F.char_length(F.coalesce("text", F.lit("")))
    parts = [
        tally(sources, {"#sources": None, "source_type": F.col("source_type"), "release_policy": F.col("release_policy"), "@source": F.col("source_id"), "@closed": F.when(closed, F.col("source_id"))}, {"topic": F.col("topic"), "region": F.col("region")}),
        tally(entities, {"#entities": None, "entity_type": F.col("type")}),
        tally(facts, {"#facts": None, "relation": F.col("predicate"), "#verified": yes("verified"), "#checked_facts": yes("manual_checked"), "@facts": F.col("evidence_source_id")}),
        tally(chunks, {"#chunks": None, "chunk_kind": F.col("chunk_kind"), "@length": length, "@chunks": F.concat_ws("\0", F.coalesce("chunk_kind", F.lit("")), F.coalesce("source_id", F.lit("")))}, sums={"#chars": length}),
        tally(questions, {"#qa": None, "answer_type": F.col("answer_type"), "#unanswerable": yes("unanswerable"), "#checked_qa": yes("manual_checked")}, {"@qa": F.array_distinct("evidence_source_ids")}),
    ]
    held = written(reduce(DataFrame.union, parts), "tallies")
    section = lambda name: held.filter(F.col("section") == name)
    shown = ("source_type", "release_policy", "topic", "region", "entity_type", "relation", "chunk_kind", "answer_type")
    row = lambda s, k, v: F.struct(F.lit(s).alias("section"), F.lit(k).alias("key"), v.cast("double").alias("value"))

    # One row of totals: sections that begin with # have one key, and links of questions are summed.
    names = ("sources", "entities", "facts", "chunks", "qa", "verified", "checked_facts", "checked_qa", "unanswerable", "chars")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    one = held.agg(*(total(F.col("section") == f"#{n}").alias(n) for n in names), total(F.col("section") == "@qa").alias("links"))
    share = lambda a, b: F.round(F.col(a) / F.greatest(F.col(b), F.lit(1)), 6)
    totals = [row("counts", k, F.col(c)) for k, c in (("sources", "sources"), ("entities", "entities"), ("facts", "facts"), ("chunks", "chunks"), ("qa", "qa"), ("manually_checked_facts", "checked_facts"), ("manually_checked_qa", "checked_qa"))]
    totals += [row("facts", "verified", F.col("verified")), row("chunks", "average_length_chars", share("chars", "chunks")), row("qa", "unanswerable_count", F.col("unanswerable")), row("qa", "unanswerable_ratio", share("unanswerable", "qa"))]
    totals += [row("average_per_source", k, share(c, "sources")) for k, c in (("facts", "facts"), ("chunks", "chunks"), ("qa", "links"))]

    # The median from the number of chunks of each length: as many rows as there are lengths.
    by_length = section("@length").select(F.col("key").cast("long").alias("length"), "n").groupBy("length").agg(F.sum("n").alias("n"))
    through = by_length.select("length", F.sum("n").over(Window.orderBy("length")).alias("upto"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("all"))
    middle = lambda half: F.min(F.when(F.col("upto") >= half, F.col("length")))
    median = through.agg(F.coalesce((middle(F.expr("(all + 1) div 2")) + middle(F.expr("all div 2 + 1"))) / 2, F.lit(0.0)).alias("m"))

    kind, of = F.substring_index("key", "\0", 1), F.substring_index("key", "\0", -1)
    by_source = section("@chunks").select(of.alias("key"), kind.alias("kind"), "n")
    audit = section("@closed").select("key").distinct().withColumn("closed", F.lit(1)).join(by_source, "key", "left")
    restricted = audit.agg(F.count_distinct("key").alias("sources"), total(F.lit(True)).alias("all"), total(F.col("kind") == "synthetic_fact").alias("synthetic"), total(F.col("kind") == "open_text").alias("open"))
    audits = [row("restricted_audit", k, v) for k, v in (("sources", F.col("sources")), ("all_chunk_records", F.col("all")), ("synthetic_fact_chunks", F.col("synthetic")), ("open_text_violations", F.col("open")), ("passed", F.col("open") == 0))]

    links = section("@facts").select(F.lit("source_facts").alias("section"), "key", "n").union(section("@qa").select(F.lit("source_qa"), "key", "n")).union(by_source.select(F.lit("source_chunks"), "key", "n"))
    registered = section("@source").select("key", F.explode(F.array(*map(F.lit, ("source_facts", "source_chunks", "source_qa")))).alias("section"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("known"))
    each = registered.unionByName(links.withColumn("known", F.lit(0))).groupBy("section", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known")).filter("known = 1")

    out = held.filter(F.col("section").isin(*shown)).groupBy("section", "key").agg(F.sum("n").cast("double").alias("value"))
    out = out.union(one.select(F.inline(F.array(*totals)))).union(median.select(F.lit("chunks"), F.lit("median_length_chars"), "m"))
    return out.union(restricted.select(F.inline(F.array(*audits)))).union(each.select("section", "key", F.col("n").cast("double")))
