"""Audits: statistics, coverage, quality, cross-checks and validation, as small result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.functions.urls import in_domains


def distribution(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))


def contributions(sources: DataFrame, **tables: DataFrame) -> DataFrame:
    """Per registered source the number of rows of each table ``(source_id)``; zeros are kept."""
    out = sources.select("source_id")
    for name, rows in tables.items():
        out = out.join(rows.groupBy("source_id").agg(F.count("*").alias(name)), "source_id", "left")
    return out.select("source_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in tables))


def average_contributions(sources: DataFrame, facts: DataFrame, chunks: DataFrame, questions: DataFrame) -> DataFrame:
    """One row: facts, chunks and question links for each registered source, on average; links to unregistered sources count too."""
    count = lambda df, name: F.broadcast(df.agg(F.count("*").alias(name)))
    links = questions.select(F.explode(F.array_distinct("evidence_source_ids")))
    one = sources.agg(F.greatest(F.count("*"), F.lit(1)).alias("sources")).join(count(facts, "f")).join(count(chunks, "c")).join(count(links, "q"))
    return one.select(*(F.round(F.col(c) / F.col("sources"), 6).alias(f"average_{n}") for c, n in (("f", "facts"), ("c", "chunks"), ("q", "questions"))))


def question_ratios(questions: DataFrame) -> DataFrame:
    """One row: questions, unanswerable ones and their share, and checked ones."""
    one = questions.agg(F.count("*").alias("questions"), F.count_if("unanswerable").alias("unanswerable"), F.count_if("manual_checked").alias("manually_checked"))
    return one.withColumn("unanswerable_ratio", F.when(F.col("questions") > 0, F.round(F.col("unanswerable") / F.col("questions"), 6)).otherwise(0.0))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, n)``: distinct values of each column, null and empty ones aside."""
    one = df.agg(*(F.count_distinct(F.nullif(F.col(c), F.lit(""))).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns))).alias("x")).select("x.*")


def chunk_lengths(chunks: DataFrame, text_col: str = "text") -> DataFrame:
    """Mean and exact median length; zeros without chunks."""
    n = F.char_length(F.coalesce(text_col, F.lit("")))
    return chunks.agg(F.count("*").alias("n"), F.round(F.coalesce(F.avg(n), F.lit(0.0)), 6).alias("mean_length"), F.coalesce(F.median(n), F.lit(0.0)).alias("median_length"))


def restricted(sources: DataFrame, domains: list[str], domain_col: str = "domain") -> DataFrame:
    """Sources whose licence, policy or domain forbids their text."""
    return sources.filter(F.col("license_status").isin("restricted", "forbidden") | F.col("release_policy").isin("local_only", "exclude", "metadata_and_facts_only") | in_domains(F.col(domain_col), domains))


def restricted_audit(sources: DataFrame, chunks: DataFrame, domains: list[str]) -> DataFrame:
    """One row: restricted sources, their chunks by kind, and whether none is open text."""
    closed = restricted(sources, domains).select("source_id")
    met = chunks.join(closed, "source_id", "left_semi")
    counts = met.agg(F.count("*").alias("chunks"), F.count_if(F.col("chunk_kind") == "synthetic_fact").alias("synthetic"), F.count_if(F.col("chunk_kind") == "open_text").alias("violations"))
    return closed.agg(F.count("*").alias("restricted_sources")).join(F.broadcast(counts)).withColumn("passed", F.col("violations") == 0)


def violating_chunks(sources: DataFrame, chunks: DataFrame, domains: list[str]) -> DataFrame:
    """``(chunk_id, source_id)`` of open text from restricted sources."""
    closed = restricted(sources, domains).select("source_id")
    return chunks.filter("chunk_kind = 'open_text'").join(closed, "source_id", "left_semi").select("chunk_id", "source_id")


def tiers(metrics: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets ``(tier, metric, low, high)`` against metrics ``(metric, value)``: status, and whether no metric of the tier is below."""
    met = targets.join(F.broadcast(metrics), "metric", "left").withColumn("value", F.coalesce("value", F.lit(0)))
    status = F.when(F.col("value") < F.col("low"), "below").when(F.col("value") > F.col("high"), "above").otherwise("in_range")
    met = met.withColumn("status", status)
    return met.withColumn("tier_passed", F.min(F.col("status") != "below").over(Window.partitionBy("tier")))


def labels_of(text: Column, targets: dict[str, list[str]]) -> Column:
    """The labels of which some alias stands in the text."""
    some = lambda aliases: reduce(lambda a, b: a | b, (F.contains(text, F.lit(x)) for x in aliases if x), F.lit(False))
    return F.array_compact(F.array(*(F.when(some(aliases), F.lit(label)) for label, aliases in targets.items())))


def coverage(sources: DataFrame, dimension: str, targets: dict[str, list[str]], minimum: dict[str, int]) -> DataFrame:
    """Parsed sources per label of an array column: count, least count, gap and status; labels without sources are kept."""
    spark = sources.sparkSession
    wanted = spark.createDataFrame([(k, minimum.get(k, 1)) for k in targets], "label string, minimum int")
    found = sources.filter("crawl_status = 'parsed'").select(F.explode(labels_of(F.array_join(dimension, " "), targets)).alias("label"))
    return _assessed(wanted, found.groupBy("label").agg(F.count("*").alias("n")))


def level_coverage(sources: DataFrame, levels: dict[str, list[str]], minimum: dict[str, int]) -> DataFrame:
    """Parsed sources per level, which is a set of source types: count, least count, gap and status; levels without sources are kept."""
    spark = sources.sparkSession
    pairs = spark.createDataFrame([(k, t) for k, types in levels.items() for t in types], "label string, source_type string")
    counted = sources.filter("crawl_status = 'parsed'").join(F.broadcast(pairs), "source_type").groupBy("label").agg(F.count("*").alias("n"))
    wanted = spark.createDataFrame([(k, minimum.get(k, 1)) for k in levels], "label string, minimum int")
    return _assessed(wanted, counted)


def coverage_report(sources: DataFrame, levels: dict[str, list[str]], topics: dict[str, list[str]], regions: dict[str, list[str]], minimum: dict[str, dict[str, int]]) -> DataFrame:
    """``(dimension, label, n, minimum, gap, status)`` of levels, topics and regions."""
    parts = {"source_levels": level_coverage(sources, levels, minimum.get("source_levels", {})), "topics": coverage(sources, "topic", topics, minimum.get("topics", {})), "regions": coverage(sources, "region", regions, minimum.get("regions", {}))}
    return reduce(DataFrame.union, (df.select(F.lit(name).alias("dimension"), "*") for name, df in parts.items()))


def _assessed(wanted: DataFrame, counted: DataFrame) -> DataFrame:
    out = wanted.join(counted, "label", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select("label", "n", "minimum", F.greatest(F.col("minimum") - F.col("n"), F.lit(0)).alias("gap"), F.when(F.col("n") < F.col("minimum"), "below").otherwise("met").alias("status"))


def coverage_matrix(sources: DataFrame, rows: dict[str, list[str]], columns: dict[str, list[str]]) -> DataFrame:
    """Parsed sources per region and topic, zeros included."""
    spark = sources.sparkSession
    parsed = sources.filter("crawl_status = 'parsed'").select(labels_of(F.array_join("region", " "), rows).alias("r"), labels_of(F.array_join("topic", " "), columns).alias("c"))
    counts = parsed.select(F.explode("r").alias("region"), "c").select("region", F.explode("c").alias("topic")).groupBy("region", "topic").agg(F.count("*").alias("n"))
    grid = spark.createDataFrame([(r, c) for r in rows for c in columns], "region string, topic string")
    return grid.join(counts, ["region", "topic"], "left").select("region", "topic", F.coalesce("n", F.lit(0)).alias("n"))


def completeness(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Per metadata column the rows that have it, and their share of all."""
    one = df.agg(F.count("*").alias("total"), *(F.count_if(c).alias(k) for k, c in columns.items()))
    pairs = F.array(*(F.struct(F.lit(k).alias("column"), F.col(k).alias("n")) for k in columns))
    return one.select("total", F.explode(pairs).alias("p")).select("p.column", "p.n", F.round(F.when(F.col("total") > 0, F.col("p.n") / F.col("total")).otherwise(0.0), 6).alias("ratio"))


def latest_documents(documents: DataFrame) -> DataFrame:
    """``(source_id, length)``: per source the text length of the document retrieved last; of several the longest, then the first.

    Lengths are taken first, so no text is shuffled, and the last document is an aggregate that is combined before the shuffle.
    """
    n = F.char_length(F.coalesce("text", F.lit("")))
    rows = documents.select("source_id", n.alias("length"), F.struct("retrieved_at", n.alias("length"), (-F.col("ordinal")).alias("first")).alias("order"))
    return rows.groupBy("source_id").agg(F.max_by("length", "order").alias("length"))


def audit_quality(sources: DataFrame, documents: DataFrame, minimum: int = 100, prefix: str = "") -> DataFrame:
    """Sources with the length of their latest document; parsed ones below the minimum become ``fetched`` and get a note once."""
    if minimum <= 0:
        raise ValueError("the minimum must be positive")
    both = sources.join(latest_documents(documents), "source_id", "left")
    selected = F.startswith("source_id", F.lit(prefix)) if prefix else F.lit(True)
    demote = selected & (F.col("length") < minimum) & (F.col("crawl_status") == "parsed")
    marker = F.concat(F.lit("document quality audit: cleaned_text_chars="), F.col("length").cast("string"), F.lit(f" below minimum={minimum}"))
    bucket = F.when(F.col("length") < 20, "<20").when(F.col("length") < 100, "20-99").when(F.col("length") < 300, "100-299").when(F.col("length") >= 300, ">=300")
    return both.withColumns({"notes": F.when(demote, T.with_note(F.col("notes"), marker)).otherwise(F.col("notes")), "crawl_status": F.when(demote, "fetched").otherwise(F.col("crawl_status")), "bucket": bucket})


def crosscheck(facts: DataFrame, candidates: DataFrame, prefix: str, note: str, normalise: bool = True) -> DataFrame:
    """Facts with the reasons against verifying them from the catalog; those of the prefix without any become verified.

    ``candidates``: (source_id, title, category, applicant). Reasons are null for facts that aren't checked.
    """
    triple = ["subject", "predicate", "object"]
    often = facts.groupBy(*triple).agg(F.count("*").alias("_many"))
    known = candidates.select(F.col("source_id").alias("evidence_source_id"), F.lit(True).alias("_there"), "title", "category", "applicant")
    both = facts.join(often, triple, "left").join(known, "evidence_source_id", "left")
    same = lambda a, b: T.catalog_value(a, normalise) == T.catalog_value(b, normalise)
    expected = F.when(F.col("predicate") == "belongs_to_category", F.col("category")).when(F.col("predicate") == "declared_by", F.col("applicant"))
    empty = F.coalesce(expected, F.lit("")) == ""
    there = F.col("_there").isNotNull()
    rules = {
        "missing_candidate": ~there,
        "subject_mismatch": there & ~same(F.col("subject"), F.col("title")),
        "unsupported_or_empty_catalog_field": there & empty,
        "object_mismatch": there & ~empty & ~same(F.col("object"), expected),
        "missing_page_evidence": F.coalesce("evidence_text", F.lit("")) == "",
        "duplicate_semantic_triple": F.col("_many") > 1,
    }
    checked = ~F.col("verified") & F.startswith("evidence_source_id", F.lit(prefix))
    reasons = F.when(checked, F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))))
    good = F.coalesce(F.size(reasons) == 0, F.lit(False))
    out = both.withColumn("reasons", reasons).withColumn("_good", good)
    return out.withColumns({"verified": F.col("verified") | F.col("_good"), "notes": F.when(F.col("_good"), T.with_note(F.col("notes"), note)).otherwise(F.col("notes"))}).select(*facts.columns, "reasons")


# Fixed value: the note of a minimised fact.
MINIMISED = "Evidence minimized to relation-specific fields only."


def minimise_evidence(facts: DataFrame, note: str = MINIMISED) -> DataFrame:
    """Evidence with a personal field is replaced by the labelled subject and object alone, and a note is added once."""
    hit = T.has_personal_field(F.col("evidence_text"))
    short = T.relation_evidence(F.col("subject"), F.col("predicate"), F.col("object"), F.col("subject_type"))
    notes = F.rtrim(F.coalesce("notes", F.lit("")))
    noted = F.when(F.contains(notes, F.lit(note)), notes).otherwise(F.trim(F.concat(notes, F.lit(f" {note}"))))
    return facts.withColumns({"evidence_text": F.when(hit, short).otherwise(F.col("evidence_text")), "notes": F.when(hit, noted).otherwise(F.col("notes"))})


def minimisation_report(facts: DataFrame) -> DataFrame:
    """One row about facts that are to be minimised: all, those with a personal field, the first ten of their ids, and what is left afterwards."""
    hit = facts.withColumn("hit", T.has_personal_field(F.col("evidence_text")))
    left = minimise_evidence(facts).agg(F.count_if(T.has_personal_field(F.col("evidence_text"))).alias("remaining"))
    first = hit.filter("hit").orderBy("fact_id").limit(10).agg(F.array_sort(F.collect_list("fact_id")).alias("sample"))
    return hit.agg(F.count("*").alias("checked"), F.count_if("hit").alias("updated")).join(F.broadcast(left)).join(F.broadcast(first))


def orphans(child: DataFrame, key: str, ref: Column, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    """``(check, record_id, detail)`` of references that have no parent."""
    refs = child.select(F.col(key).cast("string").alias("record_id"), ref.cast("string").alias("detail"))
    return refs.join(parent.select(F.col(parent_key).cast("string").alias("detail")), "detail", "left_anti").select(F.lit(check).alias("check"), "record_id", "detail")


def duplicates(df: DataFrame, columns: list[str], check: str) -> DataFrame:
    """``(check, value, n)`` of values that occur more than once."""
    value = F.concat_ws(" | ", *(F.col(c).cast("string") for c in columns))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(check).alias("check"), "value", "n")


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """``(record_id, rule)`` for each broken rule of each record; a rule that can't be decided is broken."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))
    return df.select(F.col(key).cast("string").alias("record_id"), F.explode(broken).alias("rule"))


def similar_names(names: DataFrame, candidates: DataFrame, threshold: float = 0.9, k: int = 5) -> DataFrame:
    """Suggested pairs ``(name, match, score)`` by edit distance over the longer length, never merged; all pairs at the threshold are found.

    Of two names within d edits one of d + 1 segments of the shorter stands whole in the longer, at most d places off: segments and
    the substrings that may equal them are the join keys, and lengths that can't reach the threshold never meet.
    """
    edits = lambda longer: F.floor((1 - threshold) * longer + 1e-9).cast("int")
    every = names.select("name").union(candidates.select("name")).distinct().withColumn("n", F.char_length("name"))
    short = every.select("name", "n", F.explode(F.sequence(F.col("n"), F.ceil(F.col("n") / threshold).cast("int"))).alias("m")).withColumn("d", edits(F.col("m")))
    short = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("d"))))
    start = lambda p: F.floor(F.col("n") * p / (F.col("d") + 1)).cast("int")
    short = short.withColumns({"at": start(F.col("part")), "to": start(F.col("part") + 1)}).select("name", "n", "m", "part", F.substring(F.col("name"), F.col("at") + 1, F.col("to") - F.col("at")).alias("piece"))
    long = every.select(F.col("name").alias("other"), F.col("n").alias("m")).withColumn("d", edits(F.col("m")))
    long = long.withColumn("n", F.explode(F.sequence(F.greatest(F.floor(F.col("m") * threshold - 1e-9).cast("int"), F.lit(0)), F.col("m")))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("d"))))
    long = long.withColumns({"at": start(F.col("part")), "to": start(F.col("part") + 1)}).withColumn("shift", F.explode(F.sequence(-F.col("d"), F.col("d")))).filter("at + shift >= 0")
    long = long.select("other", "n", "m", "part", F.substring(F.col("other"), F.col("at") + F.col("shift") + 1, F.col("to") - F.col("at")).alias("piece")).distinct()
    met = short.join(long, ["n", "m", "part", "piece"]).filter("name <> other").select("name", "other").distinct()
    score = F.round(1 - F.levenshtein("name", "other") / F.greatest(F.char_length("name"), F.char_length("other")), 6)
    near = met.withColumn("score", score).filter(F.col("score") >= threshold)
    both = near.select("name", F.col("other").alias("match"), "score").union(near.select("other", "name", "score")).distinct()
    both = both.join(names.select("name").distinct(), "name", "left_semi").join(candidates.select(F.col("name").alias("match")).distinct(), "match", "left_semi")
    return keep_k(both, k).select("name", "match", "score")


def keep_k(df: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("name").orderBy(F.desc("score"), F.asc("match"))
    return df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k)
