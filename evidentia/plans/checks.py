"""Registered queries for validation, schemas, seeds, listings and release packages, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import schemas
from evidentia.operators import policy, validate
from evidentia.plans import views as V
from evidentia.plans.relational import POLICY
from evidentia.plans.shared import shared_dir
from evidentia.sources import listings, release

RESTRICTED = ["s4.example.org"]


def _tables(spark: SparkSession, sf_dir: str, whole: bool) -> dict[str, DataFrame]:
    """The five tables of a release; unless ``whole``, with references that lead nowhere and texts that must not be there."""
    c = F.col
    s = V.sources(spark, sf_dir)
    kept = s if whole else s.filter("source_id <> 'src_src3'")
    text = lambda v: F.lit(v)
    none = F.array().cast("array<string>")
    sources = kept.select("source_id", "title", "publisher", text("other").alias("source_type"), "url", F.regexp_extract("url", "//([^/]*)/", 1).alias("domain"), text("zh").alias("language"), text("p").alias("province"), "region", "topic", text("2024-01-01").alias("retrieved_at"), "license_status", "release_policy", "raw_text_release", "crawl_status", text("").alias("content_sha256"), "notes")
    f = V.facts(spark, sf_dir)
    facts = f.select("fact_id", "subject", "subject_type", "predicate", "object", "object_type", "evidence_source_id", "evidence_url", F.when((c("n") % 40 == 0) & (not whole), F.concat(F.lit("地址："), "object")).otherwise(c("evidence_text")).alias("evidence_text"), text("rule").alias("extraction_method"), "verified", "confidence", "manual_checked", "notes")
    entities = f.filter("predicate = 'made_of'").groupBy(c("object").alias("name")).agg(F.min("evidence_source_id").alias("canonical_source_id")).select(F.concat(F.lit("ent_"), "name").alias("entity_id"), "name", text("MATERIAL").alias("type"), none.alias("aliases"), text("").alias("description"), text("p").alias("province"), none.alias("regions"), "canonical_source_id", text("medium").alias("confidence"), text("").alias("notes"))
    d = V.table(spark, sf_dir, "documents").filter("source is not null")
    allowed = F.concat(F.lit("src_"), "source")
    chunks = d.select(F.concat(F.lit("chk"), F.lpad(c("doc_id").cast("string"), 9, "0")).alias("chunk_id"), c("doc_id").cast("string").alias("doc_id"), allowed.alias("source_id"), F.coalesce("text", F.lit("")).alias("text"), text(0).alias("char_start"), c("n_chars").cast("int").alias("char_end"), none.alias("topic_labels"), none.alias("region_labels"), none.alias("entity_mentions"), text("open").alias("license_status"), text("full_text_allowed").alias("release_policy"), text("u").alias("source_url"), text("2024-01-01").alias("retrieved_at"), F.when(c("doc_id") % 5 == 0, "open_text").otherwise("synthetic_fact").alias("chunk_kind"), text("").alias("notes"))
    questions = f.filter("predicate = 'located_in'").select(F.concat(F.lit("q_"), "fact_id").alias("question_id"), text("q").alias("question"), text("a").alias("answer"), text("single_fact").alias("answer_type"), F.array("fact_id", *([] if whole else [F.when(c("n") % 30 == 0, "fact_none").otherwise(c("fact_id"))])).alias("evidence_fact_ids"), F.array("evidence_source_id").alias("evidence_source_ids"), none.alias("required_entities"), text("easy").alias("difficulty"), F.lit(False).alias("unanswerable"), F.lit(False).alias("manual_checked"), text("").alias("notes"))
    return {"sources": sources, "entities": entities, "facts": facts, "chunks": chunks, "questions": questions}


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(_tables(spark, sf_dir, False), RESTRICTED)


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.reference_problems(_tables(spark, sf_dir, False))


def schema_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts, questions and chunks with a column too many, one too few, and values out of their domains."""
    t = _tables(spark, sf_dir, True)
    k = F.conv(F.substring("fact_id", 6, 2), 16, 10).cast("int")
    facts = t["facts"].drop("notes").withColumns({"colour": F.lit("x"), "predicate": F.when(k % 16 == 1, "likes").otherwise(F.col("predicate")), "confidence": F.when(k % 16 == 2, "sure").otherwise(F.col("confidence")), "evidence_source_id": F.when(k % 16 == 3, " ").otherwise(F.col("evidence_source_id")), "subject": F.when(k % 16 == 4, F.lit(None)).otherwise(F.col("subject"))})
    h = F.col("doc_id").cast("int")
    chunks = t["chunks"].withColumns({"char_end": F.when(h % 7 == 0, -1).otherwise(F.col("char_end")), "release_policy": F.when(h % 11 == 0, "local_only").otherwise(F.col("release_policy"))})
    out = schemas.record_problems(facts, "facts", {"notes": F.lit("")}).select(F.lit("facts").alias("name"), "*")
    return out.union(schemas.record_problems(chunks, "chunks").select(F.lit("chunks"), "*")).union(schemas.record_problems(t["sources"], "sources").select(F.lit("sources"), "*"))


def seed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("page_id")
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), (n % len(v) + 1).cast("int"))
    seeds = V.table(spark, sf_dir, "pages").select(
        F.when(n % 2 == 0, F.concat(F.lit("seed"), n.cast("string"))).otherwise("").alias("source_id"), F.lit("t").alias("title"), "url", F.lit(None).cast("string").alias("publisher"), F.lit("").alias("source_type"), F.lit(None).cast("array<string>").alias("region"), F.array(F.lit("a")).alias("topic"),
        pick("open", "").alias("license_status"), pick("", "local_only", "full_text_allowed", "government_public").alias("release_policy"), F.when(n % 3 == 0, n % 6 == 0).alias("enabled"), pick("", "note").alias("notes"),
    )
    return policy.seed_sources(seeds, POLICY, "2024-03-04").select("source_id", "url", "domain", "source_type", "license_status", "release_policy", "raw_text_release", "crawl_status", "notes")


def _listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = V.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("t"))
    k = F.col("k").cast("string")
    total = F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit('<div class="page"><span class="total">共 '), (F.col("k") * 2).cast("string"), F.lit(" 条信息 / 共 "), (F.col("k") % 5 + 1).cast("string"), F.lit(" 页</span></div>")))
    link = F.concat(F.lit('<a href="/gdly/jd/content_'), k, F.lit('" title="标题：'), "t", F.lit("\n发表时间：2024-01-0"), (F.col("k") % 9 + 1).cast("string"), F.lit('">x</a><a href="/gdly/jd/list">y</a>'))
    article = F.concat(F.lit('<a class="app-article-item" href="//host/content/'), k, F.lit('" cid="5" contentid="9"><p class="app-article-title">'), "t", F.lit('</p><span class="app-article-date">2024</span></a>'))
    body = F.concat(F.lit('<meta name="ContentSource" content="'), F.when(F.col("k") % 2 == 0, "厅").otherwise("报"), F.lit('"><meta name="Author" content="'), F.when(F.col("k") % 5 == 0, "张").otherwise(""), F.lit('"><div class="app-content-body"><p>'), F.when(F.col("k") % 7 == 0, "禁止转载").otherwise(F.col("t")), F.lit("</p></div>"))
    return p.select(F.col("k").alias("page"), F.concat(total, link, article, body).alias("html"))


def county_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = listings.county_candidates(_listing_pages(spark, sf_dir), "jd", ["景区"], "https://www.county.cn")
    return found.select("candidate_id", "source_id", "title", "url", F.array_join("topic", "|").alias("topic"), "published_at")


def county_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.county_totals(_listing_pages(spark, sf_dir))


def county_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = listings.county_totals(_listing_pages(spark, sf_dir)).select(F.col("page").cast("string").alias("section"), "total_pages")
    found = listings.page_numbers(totals, 3)
    return found.select("section", "number", listings.page_url(F.lit("https://www.county.cn/gdly"), F.col("section"), F.col("number")).alias("url"))


def search_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.search_candidates(_listing_pages(spark, sf_dir), "http://host").select("candidate_id", "source_id", "title", "url", "published_at", "column_id", "search_content_id")


def article_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.inspect_articles(_listing_pages(spark, sf_dir), "厅").select("page", "eligible", F.array_join("reasons", ",").alias("reasons"))


def review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir, True)
    return release.review_counts(t["facts"], t["questions"], t["entities"])


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return release.export(_tables(spark, sf_dir, True), f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}")


QUERIES = {
    "va1_validation": validation,
    "j10_references": references,
    "pf1_schema_checks": schema_checks,
    "pf17_seed_sources": seed_sources,
    "sc16_county_candidates": county_candidates,
    "sc16_county_totals": county_totals,
    "sc15_county_pages": county_pages,
    "sc14_search_candidates": search_candidates,
    "pf12_article_checks": article_checks,
    "ag23_review_counts": review_counts,
    "sk5_export": export,
}

_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\.', '')"
_REFERENCES = """SELECT 'entity_source' AS "check", 'ent_' || object AS record_id, min(evidence_source_id) AS detail FROM facts WHERE predicate = 'made_of' GROUP BY object HAVING min(evidence_source_id) NOT IN (SELECT source_id FROM kept)
UNION ALL SELECT 'fact_source', fact_id, evidence_source_id FROM facts WHERE evidence_source_id NOT IN (SELECT source_id FROM kept)
UNION ALL SELECT 'chunk_source', 'chk' || lpad(CAST(doc_id AS VARCHAR), 9, '0'), 'src_' || source FROM documents WHERE source IS NOT NULL AND 'src_' || source NOT IN (SELECT source_id FROM kept)
UNION ALL SELECT 'question_source', 'q_' || fact_id, evidence_source_id FROM facts WHERE predicate = 'located_in' AND evidence_source_id NOT IN (SELECT source_id FROM kept)
UNION ALL SELECT 'question_fact', 'q_' || fact_id, 'fact_none' FROM facts WHERE predicate = 'located_in' AND n % 30 = 0"""
_KEPT = "kept AS (SELECT * FROM sources WHERE source_id <> 'src_src3')"
_FACT_K = "(instr('0123456789abcdef', substr(fact_id, 6, 1)) - 1) * 16 + instr('0123456789abcdef', substr(fact_id, 7, 1)) - 1"
ORACLE_SQL = {
    "j10_references": f"WITH {V.FACTS}, {V.SOURCES}, {_KEPT} {_REFERENCES}",
    "va1_validation": f"""WITH {V.FACTS}, {V.SOURCES}, {_KEPT},
d AS (SELECT 'chk' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS chunk_id, k.source_id, release_policy, raw_text_release, url, doc_id % 5 = 0 AS open_, coalesce(text, '') AS text FROM documents JOIN kept k ON k.source_id = 'src_' || source),
again AS (SELECT chunk_id, min(chunk_id) OVER (PARTITION BY text) AS first FROM d)
{_REFERENCES}
UNION ALL SELECT 'personal_field', fact_id, '' FROM facts WHERE n % 40 = 0
UNION ALL SELECT 'duplicate_chunk_text', chunk_id, first FROM again WHERE chunk_id <> first
UNION ALL SELECT 'open_text_policy', chunk_id, source_id FROM d WHERE open_ AND (NOT raw_text_release OR release_policy NOT IN ('full_text_allowed', 'government_public'))
UNION ALL SELECT 'open_text_domain', chunk_id, split_part(url, '/', 3) FROM d WHERE open_ AND url LIKE 'https://www.s4.example.org/%'""",
    "pf1_schema_checks": f"""WITH {V.FACTS}, {V.SOURCES}, f AS (SELECT fact_id, ({_FACT_K}) % 16 AS k FROM facts), c AS (SELECT 'chk' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS chunk_id, doc_id FROM documents WHERE source IS NOT NULL)
SELECT 'facts' AS name, NULL AS record_id, 'unknown column colour' AS rule UNION ALL SELECT 'facts', fact_id, CASE k WHEN 1 THEN 'predicate' WHEN 2 THEN 'confidence' WHEN 3 THEN 'evidence_source_required' ELSE 'null subject' END FROM f WHERE k BETWEEN 1 AND 4
UNION ALL SELECT 'chunks', chunk_id, 'offsets' FROM c WHERE doc_id % 7 = 0 UNION ALL SELECT 'chunks', chunk_id, 'policy_allows_text' FROM c WHERE doc_id % 11 = 0""",
    "pf17_seed_sources": rf"""WITH p AS (SELECT *, {_HOST} AS domain, (['open', ''])[page_id % 2 + 1] AS lic, (['', 'local_only', 'full_text_allowed', 'government_public'])[page_id % 4 + 1] AS pol, (['', 'note'])[page_id % 2 + 1] AS note FROM pages),
d AS (SELECT *, CASE WHEN domain = 'spam-farm.example.org' OR domain LIKE '%.spam-farm.example.org' THEN ['forbidden', 'exclude', 'f', 'domain is excluded'] WHEN domain = 'example.net' OR domain LIKE '%.example.net' THEN ['restricted', 'metadata_and_facts_only', 'f', 'domain is restricted']
  WHEN pol = 'local_only' THEN [CASE WHEN lic = '' THEN 'unclear' ELSE lic END, 'local_only', 'f', 'explicit conservative policy'] WHEN pol = 'government_public' AND (domain = 'example.org' OR domain LIKE '%.example.org') THEN ['government_public', 'government_public', 't', 'government page without override']
  WHEN lic = 'open' AND pol = 'full_text_allowed' THEN ['open', 'full_text_allowed', 't', 'explicit open policy'] ELSE ['unclear', 'metadata_and_facts_only', 'f', 'license could not be verified; conservative default applied'] END AS d FROM p)
SELECT CASE WHEN page_id % 2 = 0 THEN 'seed' || page_id ELSE 'src_' || substr(sha256(url), 1, 12) END AS source_id, url, domain, 'other' AS source_type, d[1] AS license_status, d[2] AS release_policy, d[3] = 't' AS raw_text_release,
  CASE WHEN page_id % 3 = 0 AND page_id % 6 <> 0 THEN 'skipped' ELSE 'pending' END AS crawl_status, CASE WHEN note = '' THEN d[4] ELSE note || '; ' || d[4] END AS notes FROM d""",
    "sc16_county_candidates": """SELECT 'candidate_' || substr(sha256('https://www.county.cn/gdly/jd/content_' || p_partkey), 1, 12) AS candidate_id, 'src_guide_content_' || p_partkey AS source_id, trim(p_name) AS title, 'https://www.county.cn/gdly/jd/content_' || p_partkey AS url, '景区' AS topic, '2024-01-0' || (p_partkey % 9 + 1) AS published_at FROM part""",
    "sc16_county_totals": "SELECT p_partkey AS page, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey * 2 END AS reported_total, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE p_partkey % 5 + 1 END AS total_pages FROM part",
    "sc15_county_pages": """SELECT section, number, 'https://www.county.cn/gdly/' || section || CASE WHEN number = 1 THEN '' ELSE '_' || number END AS url FROM (SELECT CAST(p_partkey AS VARCHAR) AS section, unnest(range(1, least(3, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE p_partkey % 5 + 1 END) + 1)) AS number FROM part)""",
    "sc14_search_candidates": """SELECT 'candidate_' || substr(sha256('http://host/content/' || p_partkey), 1, 12) AS candidate_id, 'src_whlyt_content_' || p_partkey AS source_id, trim(p_name) AS title, 'http://host/content/' || p_partkey AS url, '2024' AS published_at, '5' AS column_id, '9' AS search_content_id FROM part""",
    "pf12_article_checks": """SELECT p_partkey AS page, p_partkey % 2 = 0 AND p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AS eligible, array_to_string(list_filter([CASE WHEN p_partkey % 2 = 1 THEN 'third_party_or_missing_content_source' END, CASE WHEN p_partkey % 5 = 0 THEN 'signed_article' END,
  CASE WHEN p_partkey % 7 = 0 THEN 'page_specific_restriction' END], lambda x: x IS NOT NULL), ',') AS reasons FROM part""",
    "ag23_review_counts": f"WITH {V.FACTS} SELECT count_if(n % 17 = 0) AS facts, 0 AS questions, count(DISTINCT CASE WHEN predicate = 'made_of' THEN object END) AS audit_samples FROM facts",
    "sk5_export": f"""WITH {V.FACTS}, {V.SOURCES} SELECT 'sources' AS name, count(*) AS rows FROM sources UNION ALL SELECT 'facts', count(*) FROM facts UNION ALL SELECT 'entities', count(DISTINCT object) FROM facts WHERE predicate = 'made_of'
UNION ALL SELECT 'questions', count(*) FROM facts WHERE predicate = 'located_in' UNION ALL SELECT 'chunks', count(*) FROM documents WHERE source IS NOT NULL""",
}
