"""Facts from reviewed catalogs and collected details, each with the reasons that speak against a source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import ids
from evidentia.functions import text as T
from evidentia.functions.schemas import is_date
from evidentia.functions.urls import domain
from evidentia.plans.shared import dealt


def _facts(rows: DataFrame, subject: Column, relations: list[tuple], source: Column, evidence: Column) -> DataFrame:
    """Facts of rows by ``relations`` (predicate, object, object type, subject type, condition); an id occurs once."""
    made = [F.when(when, F.struct(s.alias("subject"), F.lit(st).alias("subject_type"), F.lit(p).alias("predicate"), o.alias("object"), F.lit(t).alias("object_type"))) for p, o, t, s, st, when in relations]
    out = dealt(rows).select(source.alias("evidence_source_id"), evidence.alias("evidence_text"), F.explode(F.array_compact(F.array(*made))).alias("f")).select("f.*", "evidence_source_id", "evidence_text")
    out = out.withColumn("fact_id", ids.fact_id(F.col("subject"), F.col("predicate"), F.col("object"), F.col("evidence_source_id")))
    # One row of equals, not a minimum for each column: each holds the evidence it is ordered by.
    whole = F.struct(*(c for c in out.columns if c != "fact_id"))
    return out.groupBy("fact_id").agg(F.min_by(whole, "evidence_text").alias("f")).select("fact_id", "f.*")


def catalog_problems(rows: DataFrame, header: DataFrame) -> DataFrame:
    """``(review_id, problem)`` of reviewed catalogs: row count, contiguous sequence, unique names with level, unique numbers and inheritors, concept of proposals.

    ``header``: (review_id, expected_rows, level, publication_status, proposed_concept); ``rows``: (review_id, sequence,
    project_number, project_name, canonical_project_name, level, inheritors).
    """
    name = F.struct(F.coalesce("canonical_project_name", "project_name").alias("n"), F.coalesce("r.level", "h.level").alias("l"))
    both = rows.alias("r").join(header.select("review_id", "level").alias("h"), "review_id").select("review_id", "sequence", "project_number", name.alias("name"), (F.size("inheritors") != F.size(F.array_distinct("inheritors"))).alias("twice"))
    number = F.nullif("project_number", F.lit(""))
    sums = both.groupBy("review_id").agg(F.count("*").alias("n"), F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.count_distinct("sequence").alias("kinds"), F.count_distinct("name").alias("names"), F.count(number).alias("numbers"), F.count_distinct(number).alias("distinct_numbers"), F.bool_or("twice").alias("twice"))
    met = header.join(sums, "review_id", "left")
    n = F.coalesce("n", F.lit(0))
    rules = {
        "row count": n != F.col("expected_rows"),
        "sequence": (F.col("low") != 1) | (F.col("high") != n) | (F.col("kinds") != n),
        "project and level": F.col("names") != n,
        "project number": F.col("numbers") != F.col("distinct_numbers"),
        "inheritors": F.col("twice"),
        "proposed concept": (F.col("publication_status") == "proposed") & (F.coalesce("proposed_concept", F.lit("")) == ""),
    }
    return met.select("review_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))).alias("problem"))


def _reviewed(facts: DataFrame) -> DataFrame:
    """Facts of a review are verified and checked by hand."""
    return facts.withColumns({"extraction_method": F.lit("manual_review"), "verified": F.lit(True), "confidence": F.lit("high"), "manual_checked": F.lit(True)})


def reviewed_catalog_facts(rows: DataFrame, header: DataFrame, normalise: bool = True) -> DataFrame:
    """Facts of reviewed project catalogs: category; the concept of a proposal, or else region, level and inheritors.

    ``rows``: (review_id, sequence, source_sequence, project_number, project_name, canonical_project_name, category, circulation_area, level,
    inheritors); ``header``: (review_id, source_id, level, publication_status, proposed_concept, batch).
    """
    h = header.select("review_id", "source_id", F.col("level").alias("h_level"), "publication_status", "proposed_concept", "batch")
    met = rows.join(h, "review_id")
    name = lambda c: T.entity_name(F.col(c), normalise)
    final = F.col("publication_status") != "proposed"
    subject = T.entity_name(F.coalesce("canonical_project_name", "project_name"), normalise)
    level = F.coalesce("level", "h_level")
    said = lambda c, *parts: F.when(F.coalesce(c, F.lit("")) != "", F.concat(*parts)).otherwise("")
    people = F.array_join("inheritors", "、")
    evidence = F.concat(
        F.lit("人工核验官方材料表格第"), F.col("sequence").cast("string"), F.lit("条（源表序号"), F.coalesce("source_sequence", "sequence").cast("string"), F.lit("）："), said(F.col("project_number"), F.lit("项目编号："), F.col("project_number"), F.lit("；")),
        F.lit("项目名称："), "project_name", F.lit("；项目类别："), "category", F.lit("；流传地区："), "circulation_area", F.lit("；项目级别："), level, said(people, F.lit("；传承人："), people), F.lit("；名录批次："), "batch",
    )
    met = met.withColumn("evidence", evidence).withColumn("person", F.explode_outer("inheritors"))
    kind = "ICH_PROJECT"
    relations = [
        ("belongs_to_category", name("category"), "CATEGORY", subject, kind, F.lit(True)),
        ("related_to_concept", name("proposed_concept"), "CONCEPT", subject, kind, ~final & (F.coalesce("proposed_concept", F.lit("")) != "")),
        ("located_in", T.region_name(F.col("circulation_area"), normalise), "REGION", subject, kind, final),
        ("has_level", T.entity_name(level, normalise), "CONCEPT", subject, kind, final),
        ("inherited_by", name("person"), "PERSON", subject, kind, final & F.col("person").isNotNull()),
    ]
    return _reviewed(_facts(met, subject, relations, F.col("source_id"), F.col("evidence")))


def reviewed_inheritor_facts(rows: DataFrame, header: DataFrame, normalise: bool = True) -> DataFrame:
    """Facts of reviewed inheritor catalogs: each row's person, and the project's level where the row has one.

    ``rows``: (review_id, sequence, project_name, person_name, project_level); ``header``: (review_id, source_id, batch).
    """
    met = rows.join(header.select("review_id", "source_id", "batch"), "review_id")
    subject = T.entity_name(F.col("project_name"), normalise)
    levelled = F.coalesce("project_level", F.lit("")) != ""
    parts = {"project": F.concat(F.lit("项目名称："), "project_name"), "person": F.concat(F.lit("代表性传承人："), "person_name"), "level": F.when(levelled, F.concat(F.lit("项目级别："), "project_level"))}
    told = lambda *order: F.concat(F.lit("人工核验官方材料第"), F.col("sequence").cast("string"), F.lit("条："), F.concat_ws("；", *(parts[p] for p in order), F.concat(F.lit("名录批次："), "batch")))
    person = ("inherited_by", T.entity_name(F.col("person_name"), normalise), "PERSON", subject, "ICH_PROJECT", F.lit(True))
    level = ("has_level", T.entity_name(F.col("project_level"), normalise), "CONCEPT", subject, "ICH_PROJECT", levelled)
    out = _facts(met, subject, [person], F.col("source_id"), told("project", "person", "level")).union(_facts(met, subject, [level], F.col("source_id"), told("project", "level", "person")))
    return _reviewed(out)


def inheritor_catalog_problems(rows: DataFrame, header: DataFrame) -> DataFrame:
    """``(review_id, problem)`` of reviewed inheritor catalogs: row count, contiguous sequence, unique pairs of project and person."""
    sums = rows.groupBy("review_id").agg(F.count("*").alias("n"), F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.count_distinct("sequence").alias("kinds"), F.count_distinct(F.struct("project_name", "person_name")).alias("pairs"))
    n = F.coalesce("n", F.lit(0))
    rules = {"row count": n != F.col("expected_rows"), "sequence": (F.col("low") != 1) | (F.col("high") != n) | (F.col("kinds") != n), "project and person": F.col("pairs") != n}
    return header.join(sums, "review_id", "left").select("review_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))).alias("problem"))


def header_problems(header: DataFrame) -> DataFrame:
    """``(review_id, problem)`` of review headers: the review's date, and the attachment's digest in lower-case hex."""
    rules = {"reviewed_at": ~is_date(F.col("reviewed_at")), "attachment_sha256": ~F.coalesce(F.col("attachment_sha256").rlike("^[0-9a-f]{64}$"), F.lit(False))}
    return header.select("review_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))).alias("problem"))


def catalog_sources(header: DataFrame) -> DataFrame:
    """Registry rows of reviewed catalogs: parsed, with facts and metadata only."""
    notes = F.concat(F.lit("Manually reviewed official "), "catalog_kind", F.lit(" catalog attachment; review_id="), "review_id", F.lit("; parent_page="), "parent_page_url", F.lit("; raw attachment is not released."))
    return header.select(
        "source_id", "title", "publisher", F.lit("municipal_or_county_government").alias("source_type"), F.col("attachment_url").alias("url"), domain(F.col("attachment_url")).alias("domain"), "region", "topic", F.col("reviewed_at").alias("retrieved_at"),
        F.lit("unclear").alias("license_status"), F.lit("metadata_and_facts_only").alias("release_policy"), F.lit(False).alias("raw_text_release"), F.lit("parsed").alias("crawl_status"), F.col("attachment_sha256").alias("content_sha256"), notes.alias("notes"),
    )


def attachment_problems(header: DataFrame, files: DataFrame) -> DataFrame:
    """``(review_id, problem)``: reviewed attachments (review_id, raw_path, attachment_sha256) that aren't among ``files`` (path, sha256), or differ."""
    met = header.select("review_id", "raw_path", "attachment_sha256").join(files.select(F.col("path").alias("raw_path"), "sha256"), "raw_path", "left")
    problem = F.when(F.col("sha256").isNull(), "missing").when(F.col("sha256") != F.col("attachment_sha256"), "sha256 mismatch")
    return met.select("review_id", problem.alias("problem")).filter("problem is not null")


def review_problems(review: DataFrame, expected_sources: int, expected_facts: int, prefix: str = "src_tibetan_museum_exhibit_") -> DataFrame:
    """``(source_id, problem)`` of a museum review (source_id, exhibit_id, ...): row count, four facts a source, unique ids that agree with the exhibit."""
    spark = review.sparkSession
    n = review.count()
    whole = [(None, "row count")] * (n != expected_sources) + [(None, "facts per source")] * (expected_facts != 4 * expected_sources)
    twice = review.groupBy("source_id").agg(F.count("*").alias("n")).filter("n > 1").select("source_id", F.lit("repeated source"))
    other = review.filter(F.col("source_id") != F.concat(F.lit(prefix), F.col("exhibit_id").cast("string"))).select("source_id", F.lit("exhibit id"))
    return spark.createDataFrame(whole, "source_id string, problem string").union(twice).union(other)


def inheritor_facts(candidates: DataFrame, documents: DataFrame, normalise: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(facts, issues)`` of inheritor candidates: all required fields have to be there and on the collected page.

    ``candidates``: (source_id, person, project, category, applicant, project_number, ethnic_group); ``documents``: one
    for each source, (source_id, title, text).
    """
    met = candidates.join(documents.select("source_id", F.col("title").alias("_title"), F.col("text").alias("_text"), F.lit(True).alias("_there")), "source_id", "left")
    key = lambda c: T.catalog_value(c, normalise)
    there = F.col("_there").isNotNull()
    page = key(F.coalesce("_text", F.lit("")))
    value = lambda f: F.coalesce(F.col(f), F.lit(""))
    rules = {f"missing_{f}": value(f) == "" for f in ("person", "project", "category", "applicant", "project_number")}
    rules["missing_document"] = ~there
    rules["person_title_mismatch"] = there & (key(value("person")) != key(F.substring_index(F.coalesce("_title", F.lit("")), " - ", 1)))
    rules |= {f"page_missing_{f}": there & (value(f) != "") & ~F.contains(page, key(value(f))) for f in ("person", "project", "category", "applicant", "ethnic_group")}
    judged = met.withColumn("reasons", F.array_sort(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))))
    good = judged.filter(F.size("reasons") == 0)
    name = lambda f: T.entity_name(F.col(f), normalise)
    evidence = F.concat_ws("；", F.concat(F.lit("姓名："), "person"), F.when(value("ethnic_group") != "", F.concat(F.lit("民族："), "ethnic_group")), F.concat(F.lit("类别："), "category"), F.concat(F.lit("项目编号："), "project_number"), F.concat(F.lit("项目名称："), "project"), F.concat(F.lit("申报地区或单位："), "applicant"))
    p, always = name("project"), F.lit(True)
    relations = [
        ("inherited_by", name("person"), "PERSON", p, "ICH_PROJECT", always),
        ("belongs_to_category", name("category"), "CATEGORY", p, "ICH_PROJECT", always),
        ("declared_by", name("applicant"), "ORGANIZATION", p, "ICH_PROJECT", always),
        ("has_level", F.lit("国家级"), "CONCEPT", p, "ICH_PROJECT", always),
        ("associated_with_ethnic_group", name("ethnic_group"), "ETHNIC_GROUP", name("person"), "PERSON", value("ethnic_group") != ""),
    ]
    return _facts(good, p, relations, F.col("source_id"), evidence), judged.filter(F.size("reasons") > 0).select("source_id", "reasons")


def museum_facts(candidates: DataFrame, sources: DataFrame, details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(facts, issues)`` of museum objects whose candidate, registry row and collected detail agree; objects with one name get their id.

    ``candidates``: (source_id, title, url, exhibit_id, museum, category, period, texture); ``sources``: (source_id, url, crawl_status,
    content_sha256); ``details``: (source_id, sha256, d_title, d_museum, d_category, d_period, d_texture).
    """
    many = candidates.groupBy("title").agg(F.count("*").alias("_many"))
    s = sources.select("source_id", F.col("url").alias("s_url"), "crawl_status", "content_sha256", F.lit(True).alias("_s"))
    met = candidates.join(many, "title", "left").join(s, "source_id", "left").join(details.withColumn("_d", F.lit(True)), "source_id", "left")
    known, got = F.col("_s").isNotNull(), F.col("_d").isNotNull()
    hashed = known & got & F.col("content_sha256").eqNullSafe(F.col("sha256"))
    rules = {"missing_registry_source": ~known, "missing_raw_detail": known & ~got, "content_sha256_mismatch": known & got & ~hashed}
    rules |= {f"{f}_mismatch": hashed & ~F.coalesce(F.col(f), F.lit("")).eqNullSafe(F.coalesce(F.col(f"d_{f}"), F.lit(""))) for f in ("title", "museum", "category", "period", "texture")}
    rules |= {"source_not_parsed": hashed & (F.col("crawl_status") != "parsed"), "source_url_mismatch": hashed & (F.col("s_url") != F.col("url"))}
    judged = met.withColumn("reasons", F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))))
    good = judged.filter(F.size("reasons") == 0)
    subject = F.when(F.col("_many") > 1, F.concat("title", F.lit("（展品ID："), "exhibit_id", F.lit("）"))).otherwise(F.col("title"))
    shown = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("未标注"))
    evidence = F.concat(F.lit("展品ID："), "exhibit_id", F.lit("；文物名称："), "title", F.lit("；馆藏机构："), "museum", F.lit("；文物类别："), shown("category"), F.lit("；年代："), shown("period"), F.lit("；质地："), shown("texture"))
    kind = "MUSEUM_OBJECT"
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    relations = [
        ("held_by", F.col("museum"), "ORGANIZATION", subject, kind, F.lit(True)),
        ("made_of", text("texture"), "MATERIAL", subject, kind, F.lit(True)),
        ("belongs_to_category", F.col("category"), "CATEGORY", subject, kind, text("category") != ""),
        ("created_in_period", F.col("period"), "HISTORICAL_PERIOD", subject, kind, text("period") != ""),
    ]
    return _facts(good, subject, relations, F.col("source_id"), evidence), judged.filter(F.size("reasons") > 0).select("source_id", "reasons")


def mark_reviewed(facts: DataFrame, sources: DataFrame, review: DataFrame, review_id: str, reviewed_at: str) -> tuple[DataFrame, DataFrame]:
    """``(facts, issues)``: facts of reviewed objects become manually checked, all or none: any issue cancels every mark.

    ``review``: (source_id, name, category, period, museum, material). A source's facts have to be exactly the four relations.
    """
    predicates = {"belongs_to_category": "category", "created_in_period": "period", "held_by": "museum", "made_of": "material"}
    own = facts.join(review.select(F.col("source_id").alias("evidence_source_id")), "evidence_source_id", "left_semi")
    sums = own.groupBy(F.col("evidence_source_id").alias("source_id")).agg(
        F.count("*").alias("n"), *(F.max(F.when((F.col("predicate") == p) & (F.col("subject_type") == "MUSEUM_OBJECT"), F.col("object"))).alias(f"f_{c}") for p, c in predicates.items()),
        F.min("subject").alias("low"), F.max("subject").alias("high"), F.bool_and(F.col("verified") & (F.col("confidence") == "high")).alias("sure"),
    )
    met = review.join(sources.select("source_id", "crawl_status", "content_sha256", F.lit(True).alias("_s")), "source_id", "left").join(sums, "source_id", "left")
    there = F.col("_s").isNotNull()
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in predicates.values())) & (F.coalesce("n", F.lit(0)) == 4)
    rules = {
        "missing_registry_source": ~there,
        "source_not_parsed": there & (F.col("crawl_status") != "parsed"),
        "missing_content_sha256": there & (F.char_length(F.coalesce("content_sha256", F.lit(""))) != 64),
        "fact_set_mismatch": there & ~same,
        "subject_mismatch": there & same & ((F.col("low") != F.col("name")) | (F.col("high") != F.col("name"))),
        "fact_not_high_confidence_verified": there & same & ~F.col("sure"),
    }
    issues = met.select("source_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))).alias("issue"))
    gate = issues.agg((F.count("*") == 0).alias("_open"))
    marks = review.select("source_id").join(sources.select("source_id", "content_sha256"), "source_id").select(F.col("source_id").alias("evidence_source_id"), "content_sha256", F.lit(True).alias("_hit"))
    both = facts.join(marks, "evidence_source_id", "left").join(F.broadcast(gate))
    hit = F.coalesce("_hit", F.lit(False)) & F.col("_open")
    marker = F.concat(F.lit(f"manual_review_id={review_id}; reviewed_at={reviewed_at}; source_content_sha256="), "content_sha256")
    out = both.withColumns({"manual_checked": F.col("manual_checked") | hit, "notes": F.when(hit, T.with_note(F.col("notes"), marker)).otherwise(F.col("notes"))})
    return out.select(*facts.columns), issues
