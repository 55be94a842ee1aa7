"""Registered queries for identities, policy, merges, statistics and audits, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import ids, urls
from evidentia.functions import text as T
from evidentia.operators import audit as A
from evidentia.operators import entities as E
from evidentia.operators import merge as M
from evidentia.operators import policy as P
from evidentia.plans import views as V

POLICY = {
    "excluded_domains": ["spam-farm.example.org"],
    "restricted_domains": ["example.net"],
    "government_domains": ["example.org"],
    "strong_restriction_phrases": ["worthless", "idiot"],
    "defaults": {},
}
NOTE = "checked against the catalog"
FACT_COLUMNS = "fact_id, subject, subject_type, predicate, object, object_type, evidence_source_id, verified, manual_checked"


def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = V.facts(spark, sf_dir)
    c = F.col
    return f.select(
        "fact_id", ids.entity_id(c("subject_type"), c("subject")).alias("entity_id"), ids.entity_node_id(c("subject_type"), c("subject")).alias("node_id"),
        ids.chunk_id(c("fact_id"), F.lit(0), F.char_length("evidence_text"), c("evidence_text")).alias("chunk_id"),
        ids.document_id(c("evidence_source_id"), c("evidence_text")).alias("doc_id"), ids.synthetic_document_id(c("subject"), c("evidence_source_id")).alias("synthetic_id"),
        ids.question_id(c("evidence_text")).alias("question_id"), ids.source_id(c("evidence_url")).alias("source_id"), ids.candidate_id(c("evidence_url")).alias("candidate_id"),
        ids.template_variant(c("subject"), 7).alias("variant"),
    )


def _hex_fold(key: str, n: int) -> str:
    digits = f"list_transform(range(1, 65), lambda i: instr('0123456789abcdef', substr(sha256({key}), CAST(i AS INT), 1)) - 1)"
    return f"list_reduce(list_prepend(0, {digits}), lambda a, d: (a * 16 + d) % {n})"


def release_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "pages")
    n = F.col("page_id") % 4
    declared = F.element_at(F.array(*map(F.lit, ("", "local_only", "government_public", "full_text_allowed"))), (n + 1).cast("int"))
    decision = P.decide(F.col("url"), F.col("html"), F.when(F.col("page_id") % 3 == 0, "open").otherwise(""), declared, POLICY)
    return pages.select("page_id", urls.domain(F.col("url")).alias("domain"), decision.alias("d")).select("page_id", "domain", "d.*")


def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "pages").select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


_HOST = r"regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\.', '')"
CANONICAL = rf"""canonical AS (
  SELECT page_id, url, host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || list_aggregate(list_sort(string_split(query, '&')), 'string_agg', '&') END AS canonical
  FROM (SELECT page_id, url, {_HOST} AS host, regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') AS path, regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages)
)"""


def title_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best page of each title: by host class, then number, then address."""
    pages = V.table(spark, sf_dir, "pages").withColumn("title", T.text_key(F.regexp_extract("html", "<title>([^<]*)</title>", 1)))
    return M.keep_one(pages, ["title"], F.desc(F.col("url").startswith("https")), F.desc("page_id"), F.asc("url")).select("page_id", "title")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Existing facts, and new ones of which a part has the same triple under another id."""
    f = V.facts(spark, sf_dir)
    new = f.filter("n % 3 <> 0").withColumn("fact_id", F.when(F.col("n") % 4 == 0, F.concat(F.col("fact_id"), F.lit("b"))).otherwise(F.col("fact_id")))
    return f.filter("n % 2 = 0"), new.withColumn("verified", F.lit(False))


HALVES = """old AS (SELECT * FROM facts WHERE n % 2 = 0),
new AS (SELECT * REPLACE (CASE WHEN n % 4 = 0 THEN fact_id || 'b' ELSE fact_id END AS fact_id, false AS verified) FROM facts WHERE n % 3 <> 0)"""
_COLS = [c.strip() for c in FACT_COLUMNS.split(",")]


def merge_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_extracted(*_halves(spark, sf_dir)).select(*_COLS)


def merge_inheritor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_generated(*_halves(spark, sf_dir), "src_src1").select(*_COLS, "retained")


def merge_owner3(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged, _ = M.merge_owned(*_halves(spark, sf_dir))
    return merged.select(*_COLS)


def merge_owner5(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, skipped = M.merge_owned(*_halves(spark, sf_dir), M.TYPED_TRIPLE)
    return skipped


def _owned_sql(key: str, result: str) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in key.split(", "))
    return f"""WITH {V.FACTS}, {HALVES},
owners AS (SELECT {key}, max(fact_id) AS owner FROM old GROUP BY {key}),
met AS (SELECT a.*, b.owner FROM new a LEFT JOIN owners b ON {on}),
free AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY fact_id) AS r FROM met WHERE owner IS NULL OR owner = fact_id),
skipped AS (SELECT fact_id, owner FROM met WHERE owner <> fact_id
  UNION ALL SELECT a.fact_id, b.fact_id FROM free a JOIN free b ON {on} AND b.r = 1 WHERE a.r > 1 AND a.fact_id <> b.fact_id)
{result}"""


def _registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select(F.concat(F.lit("s"), (F.col("page_id") % 97).cast("string")).alias("source_id"), F.regexp_replace("url", r"[?#].*$", "").alias("url"), F.col("page_id").alias("ordinal"))


def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _registry_rows(spark, sf_dir)
    rows = rows.union(rows.filter("ordinal % 5 = 0").select(F.lit("thief").alias("source_id"), "url", F.col("ordinal") + 100000))
    old = M.keep_last(rows.filter("ordinal % 2 = 0"), ["source_id"], "ordinal")
    return M.upsert_owned(old, rows.filter("ordinal % 2 = 1"), "source_id", urls.canonical_url(F.col("url")), "ordinal")


def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _registry_rows(spark, sf_dir)
    return M.upsert(M.keep_last(rows.filter("ordinal % 3 = 0"), ["source_id"], "ordinal"), rows.filter("ordinal % 3 <> 0"), ["source_id"], "ordinal")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = E.build_entities(V.facts(spark, sf_dir))
    return out.select("entity_id", "name", "type", F.array_join("aliases", "|").alias("aliases"), F.array_join("regions", "|").alias("regions"), "canonical_source_id", "confidence")


def alias_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.alias_map(E.build_entities(V.facts(spark, sf_dir)))


_KEY = r"trim(regexp_replace({0}, '[\s\x1c-\x1f]+', '', 'g'), '，。；：、')"
ENTITIES = rf"""
mentions AS (
  SELECT fact_id, evidence_source_id, confidence, subject AS raw, subject_type AS type, 0 AS side, CASE WHEN predicate = 'located_in' THEN {_KEY.format("object")} END AS place FROM facts
  UNION ALL SELECT fact_id, evidence_source_id, confidence, object, object_type, 1, CASE WHEN predicate = 'located_in' AND object = subject THEN {_KEY.format("object")} END FROM facts
),
named AS (SELECT *, {_KEY.format("raw")} AS name FROM mentions),
spelled AS (SELECT name, list(DISTINCT raw) AS spellings FROM named GROUP BY name),
grouped AS (
  SELECT name, type, list_sort(list_distinct(list_concat(coalesce(list(DISTINCT place) FILTER (place IS NOT NULL), []), coalesce(list(DISTINCT name) FILTER (type = 'REGION'), [])))) AS regions,
         min_by((evidence_source_id, confidence), (fact_id, side)) AS first
  FROM named GROUP BY name, type
),
entities AS (
  SELECT 'ent_' || substr(sha256(type || chr(0) || name), 1, 12) AS entity_id, name, type, list_sort(list_filter(spellings, lambda s: s <> name)) AS aliases, regions, first[1] AS canonical_source_id, first[2] AS confidence
  FROM grouped JOIN spelled USING (name)
)"""


def crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = V.facts(spark, sf_dir)
    part = V.table(spark, sf_dir, "part")
    candidates = part.filter("p_partkey % 5 <> 0").select(F.concat(F.lit("src_part_"), F.col("p_partkey").cast("string")).alias("source_id"), F.concat(F.lit("Part#"), (F.col("p_partkey") - (F.col("p_partkey") % 7 == 0).cast("int")).cast("string")).alias("title"), F.when(F.col("p_partkey") % 6 == 0, "").otherwise(F.col("p_type")).alias("category"), F.lit("").alias("applicant"))
    own = f.filter("subject like 'Part#%'").withColumn("evidence_source_id", F.concat(F.lit("src_part_"), F.col("n").cast("string"))).withColumn("verified", F.col("n") % 11 == 0)
    out = A.crosscheck(own, candidates, "src_part_", NOTE)
    return out.select("fact_id", F.array_join("reasons", ",").alias("reasons"), "verified", "notes")


#: Field names that personal data stand under, and some that aren't among them.
FIELDS = ("性别", "出生日期", "出生年月", "出生时间", "详细地址", "地址", "联系电话", "电话号码", "身份证", "身份证号", "住址", "电话", "手机")
_FIELDS_SQL = "(['性别', '出生日期', '出生年月', '出生时间', '详细地址', '地址', '联系电话', '电话号码', '身份证', '身份证号', '住址', '电话', '手机'])[n % 13 + 1]"


def _with_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose evidence names a field before its value, one of FIELDS each."""
    field = F.element_at(F.array(*map(F.lit, FIELDS)), (F.col("n") % 13 + 1).cast("int"))
    return V.facts(spark, sf_dir).withColumn("evidence_text", F.concat(F.lit("姓名 "), field, F.when(F.col("n") % 2 == 0, "：").otherwise(" : "), "object"))


def minimize_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.minimise_evidence(_with_fields(spark, sf_dir)).select("fact_id", "evidence_text", "notes")


def minimisation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.minimisation_report(_with_fields(spark, sf_dir)).select("checked", "updated", "remaining", F.array_join("sample", "|").alias("sample"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").filter("source is not null")
    return d.select(F.concat(F.lit("src_"), "source").alias("source_id"), "text", F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("retrieved_at"), F.col("doc_id").alias("ordinal"))


def quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = A.audit_quality(V.sources(spark, sf_dir), _documents(spark, sf_dir), 1500)
    return out.select("source_id", "length", "bucket", "crawl_status", "notes")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").filter("source is not null")
    return d.select(F.concat(F.lit("chk"), F.col("doc_id").cast("string")).alias("chunk_id"), F.concat(F.lit("src_"), "source").alias("source_id"), "text", F.when(F.col("doc_id") % 5 < 2, "open_text").otherwise("synthetic_fact").alias("chunk_kind"))


def dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, s = V.facts(spark, sf_dir), V.sources(spark, sf_dir)
    parts = {
        "relation": A.distribution(f, F.col("predicate")), "entity_type": A.distribution(f, F.col("subject_type")), "release_policy": A.distribution(s, F.col("release_policy")),
        "topic": A.distribution(s.select(F.explode("topic").alias("t")), F.col("t")), "verified": A.distribution(f, F.col("verified").cast("string")), "manual": A.distribution(f, F.col("manual_checked").cast("string")),
    }
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("section"), "value", "n")
        out = part if out is None else out.union(part)
    return out


def contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = V.facts(spark, sf_dir).select(F.col("evidence_source_id").alias("source_id"))
    return A.contributions(V.sources(spark, sf_dir), facts=f, chunks=_chunks(spark, sf_dir))


def chunk_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.chunk_lengths(_chunks(spark, sf_dir))


def restricted_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.sources(spark, sf_dir).withColumn("domain", urls.domain(F.col("url")))
    return A.restricted_audit(s, _chunks(spark, sf_dir), ["s4.example.org"])


TARGETS = [("v1", "facts", 100, 500), ("v1", "sources", 5, 50), ("v2", "facts", 1000, 100000), ("v2", "sources", 21, 50), ("v3", "chunks", 10, 1000000)]


def tier_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = V.facts(spark, sf_dir).agg(F.lit("facts").alias("metric"), F.count("*").alias("value"))
    metrics = metrics.union(V.sources(spark, sf_dir).agg(F.lit("sources"), F.count("*"))).union(_chunks(spark, sf_dir).agg(F.lit("chunks"), F.count("*")))
    return A.tiers(metrics, spark.createDataFrame(TARGETS, "tier string, metric string, low long, high long"))


TOPICS = {"zero": ["topic 0"], "one": ["topic 1", "topic one"], "none": ["topic 9"]}
REGIONS = {"north": ["region 0", "region 1"], "south": ["region 2"], "west": ["region 3", "region 4"]}


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.coverage(V.sources(spark, sf_dir), "topic", TOPICS, {"zero": 4, "one": 50, "none": 1})


def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.coverage_matrix(V.sources(spark, sf_dir), REGIONS, TOPICS)


def metadata_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    return A.completeness(d, {"lang": F.col("lang") != "", "source": F.col("source") != "", "long": F.col("n_chars") > 1000})


def validate_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, s = V.facts(spark, sf_dir), V.sources(spark, sf_dir).filter("release_policy <> 'local_only'")
    labels, docs = V.table(spark, sf_dir, "labels"), V.table(spark, sf_dir, "documents").filter("doc_id % 10 <> 3")
    a = A.orphans(f, "fact_id", F.col("evidence_source_id"), s, "source_id", "fact_source")
    return a.union(A.orphans(labels, "doc_id", F.col("doc_id"), docs, "doc_id", "label_document"))


def validate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").withColumn("sha", F.sha2("text", 256))
    pages = V.table(spark, sf_dir, "pages").withColumn("host", urls.domain(F.col("url")))
    return A.duplicates(d, ["sha"], "text").union(A.duplicates(pages, ["host"], "host")).union(A.duplicates(V.facts(spark, sf_dir), ["subject", "predicate"], "subject_predicate"))


def validate_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    rules = {"lang_domain": F.col("lang").isin("en", "de"), "length_agrees": F.col("n_chars") == F.char_length("text"), "long_enough": F.col("n_chars") >= 500, "source_known": F.col("source").rlike("^src[0-9]$")}
    return A.violations(d, "doc_id", rules)


def personal_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _with_fields(spark, sf_dir)
    return f.filter(T.has_personal_field(F.col("evidence_text"))).select("fact_id", "evidence_text")


def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of regions and entities, some with white space or marks, as keys, regions and entities."""
    spellings = [*T.REGION_ALIASES, *T.ENTITY_ALIASES, "海 北", "青海。", "堆绣()", "x y"]
    rows = V.table(spark, sf_dir, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, spellings)), (F.col("p_partkey") % len(spellings) + 1).cast("int")).alias("raw"))
    return rows.select("p_partkey", "raw", T.text_key(F.col("raw")).alias("key"), T.region_name(F.col("raw")).alias("region"), T.entity_name(F.col("raw")).alias("entity"), T.catalog_value(F.col("raw")).alias("value"))


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = V.facts(spark, sf_dir)
    return f.select(F.col("fact_id").alias("question_id"), F.array("evidence_source_id", F.lit("src_elsewhere")).alias("evidence_source_ids"), (F.col("n") % 10 == 0).alias("unanswerable"), "manual_checked")


def average_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.average_contributions(V.sources(spark, sf_dir), V.facts(spark, sf_dir), _chunks(spark, sf_dir), _questions(spark, sf_dir))


def question_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.question_ratios(_questions(spark, sf_dir))


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.sources(spark, sf_dir).withColumn("domain", urls.domain(F.col("url")))
    return A.distinct_values(s.withColumn("publisher", F.when(F.col("publisher") == "publisher 0", "").otherwise(F.col("publisher"))), ["publisher", "domain"])


LEVELS = {"open": ["open"], "public": ["government_public", "open"], "closed": ["restricted"], "none": ["forbidden"]}


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.sources(spark, sf_dir).withColumn("source_type", F.col("license_status"))
    return A.coverage_report(s, LEVELS, TOPICS, REGIONS, {"source_levels": {"open": 2, "closed": 30}, "topics": {"zero": 4, "one": 50, "none": 1}, "regions": {"south": 9}})


def violating_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = V.sources(spark, sf_dir).withColumn("domain", urls.domain(F.col("url")))
    return A.violating_chunks(s, _chunks(spark, sf_dir), ["s4.example.org"])


def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = V.table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_type", "p_brand").alias("name")).distinct()
    return A.similar_names(names, names, 0.9, 5)


QUERIES = {
    "i_stable_ids": stable_ids,
    "pf2_release_policy": release_policy,
    "pf5_canonical_url": canonical_url,
    "w2_title_dedup": title_dedup,
    "up3_merge_extracted": merge_extracted,
    "up4_merge_inheritor": merge_inheritor,
    "up5_merge_owner3": merge_owner3,
    "up6_merge_owner5_skipped": merge_owner5,
    "up2_registry_upsert": registry_upsert,
    "up1_upsert_last_wins": upsert_last_wins,
    "t17_entities": entities,
    "t17_alias_map": alias_map,
    "up9_crosscheck": crosscheck,
    "up14_minimize_evidence": minimize_evidence,
    "up15_quality_audit": quality_audit,
    "ag2_dataset_stats": dataset_stats,
    "ag3_contributions": contributions,
    "ag5_chunk_lengths": chunk_lengths,
    "ag7_restricted_audit": restricted_audit,
    "ag8_tier_assessment": tier_assessment,
    "ag12_coverage_gaps": coverage_gaps,
    "ag11_coverage_matrix": coverage_matrix,
    "ag14_metadata_completeness": metadata_completeness,
    "va4_orphans": validate_orphans,
    "va3_duplicates": validate_duplicates,
    "va2_schema": validate_schema,
    "va5_personal_fields": personal_fields,
    "up14_minimisation_report": minimisation_report,
    "t8_canonical_names": canonical_names,
    "ag4_average_contributions": average_contributions,
    "ag6_question_ratios": question_ratios,
    "ag13_distinct_values": distinct_values,
    "ag10_coverage_report": coverage_report,
    "ag7_violating_chunks": violating_chunks,
    "tk10_similar_names": similar_names,
}

_REASON = "regexp_replace({0}, '[\\s]+', '', 'g')"
ORACLE_SQL = {
    "i_stable_ids": f"""WITH {V.FACTS} SELECT fact_id, 'ent_' || substr(sha256(subject_type || chr(0) || subject), 1, 12) AS entity_id, 'entity:' || substr(sha256(subject_type || chr(0) || subject), 1, 16) AS node_id,
  'chk_' || substr(sha256(fact_id || chr(0) || '0' || chr(0) || length(evidence_text) || chr(0) || evidence_text), 1, 12) AS chunk_id, 'doc_' || substr(sha256(evidence_source_id || chr(0) || evidence_text), 1, 12) AS doc_id,
  'doc_synthetic_' || substr(sha256(subject || evidence_source_id), 1, 12) AS synthetic_id, 'q_' || substr(sha256(evidence_text), 1, 12) AS question_id, 'src_' || substr(sha256(evidence_url), 1, 12) AS source_id,
  'candidate_' || substr(sha256(evidence_url), 1, 12) AS candidate_id, {_hex_fold("subject", 7)} AS variant FROM facts""",
    "pf2_release_policy": f"""
SELECT page_id, domain, d[1] AS license_status, d[2] AS release_policy, d[3] = 't' AS raw_text_release, d[4] AS reason FROM (
  SELECT page_id, domain, CASE
    WHEN domain = 'spam-farm.example.org' OR domain LIKE '%.spam-farm.example.org' THEN ['forbidden', 'exclude', 'f', 'domain is excluded']
    WHEN domain = 'example.net' OR domain LIKE '%.example.net' THEN ['restricted', 'metadata_and_facts_only', 'f', 'domain is restricted']
    WHEN contains(html, 'worthless') THEN ['restricted', 'metadata_and_facts_only', 'f', 'page contains restriction phrase: worthless']
    WHEN contains(html, 'idiot') THEN ['restricted', 'metadata_and_facts_only', 'f', 'page contains restriction phrase: idiot']
    WHEN page_id % 4 = 1 THEN [CASE WHEN page_id % 3 = 0 THEN 'open' ELSE 'unclear' END, 'local_only', 'f', 'explicit conservative policy']
    WHEN page_id % 4 = 2 AND (domain = 'example.org' OR domain LIKE '%.example.org') THEN ['government_public', 'government_public', 't', 'government page without override']
    WHEN page_id % 4 = 3 AND page_id % 3 = 0 THEN ['open', 'full_text_allowed', 't', 'explicit open policy']
    ELSE ['unclear', 'metadata_and_facts_only', 'f', 'license could not be verified; conservative default applied'] END AS d
  FROM (SELECT *, {_HOST} AS domain FROM pages))""",
    "pf5_canonical_url": f"WITH {CANONICAL} SELECT page_id, canonical FROM canonical",
    "w2_title_dedup": rf"""
SELECT page_id, title FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY url LIKE 'https%' DESC, page_id DESC, url) AS r
  FROM (SELECT *, {_KEY.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title FROM pages)) WHERE r = 1""",
    "up3_merge_extracted": f"""WITH {V.FACTS}, {HALVES}, reviewed AS (SELECT * FROM old WHERE verified OR manual_checked),
fresh AS (SELECT *, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY fact_id) AS r FROM new
  WHERE fact_id NOT IN (SELECT fact_id FROM reviewed) AND (subject, predicate, object) NOT IN (SELECT (subject, predicate, object) FROM reviewed))
SELECT {FACT_COLUMNS} FROM reviewed UNION ALL SELECT {FACT_COLUMNS} FROM fresh WHERE r = 1""",
    "up4_merge_inheritor": f"""WITH {V.FACTS}, {HALVES}, kept AS (SELECT * FROM old WHERE evidence_source_id NOT LIKE 'src\\_src1%' ESCAPE '\\' OR manual_checked),
fresh AS (SELECT *, row_number() OVER (PARTITION BY subject, predicate, object ORDER BY fact_id) AS r FROM new WHERE (subject, predicate, object) NOT IN (SELECT (subject, predicate, object) FROM kept))
SELECT {FACT_COLUMNS}, false AS retained FROM kept WHERE fact_id NOT IN (SELECT fact_id FROM fresh WHERE r = 1) UNION ALL SELECT {FACT_COLUMNS}, true FROM fresh WHERE r = 1""",
    "up5_merge_owner3": _owned_sql("subject, predicate, object", f"SELECT {FACT_COLUMNS} FROM old WHERE fact_id NOT IN (SELECT fact_id FROM free WHERE r = 1) UNION ALL SELECT {FACT_COLUMNS} FROM free WHERE r = 1"),
    "up6_merge_owner5_skipped": _owned_sql("subject, subject_type, predicate, object, object_type", "SELECT fact_id, owner FROM skipped"),
    "up2_registry_upsert": rf"""WITH RECURSIVE rows_ AS (SELECT 's' || (page_id % 97) AS source_id, regexp_replace(url, '[?#].*$', '') AS url, page_id AS ordinal FROM pages),
every AS (SELECT * FROM rows_ UNION ALL SELECT 'thief', url, ordinal + 100000 FROM rows_ WHERE ordinal % 5 = 0),
old AS (SELECT source_id, url, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ordinal DESC) AS r FROM every WHERE ordinal % 2 = 0) WHERE r = 1),
both_ AS (SELECT *, 0 AS fresh FROM old UNION ALL SELECT *, 1 FROM every WHERE ordinal % 2 = 1),
addressed AS (SELECT *, {_HOST} || coalesce(nullif(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '/+$', ''), ''), '/') AS address FROM both_),
steps AS (SELECT row_number() OVER (ORDER BY ordinal, source_id) AS k, * FROM addressed WHERE fresh = 1),
replay AS (
  SELECT 0 AS k, (SELECT map(list(source_id ORDER BY ordinal), list(address ORDER BY ordinal)) FROM addressed WHERE fresh = 0) AS lives, (SELECT map(list(source_id ORDER BY ordinal), list(ordinal ORDER BY ordinal)) FROM addressed WHERE fresh = 0) AS held,
         (SELECT map(list(address), list(source_id)) FROM (SELECT address, max_by(source_id, ordinal) AS source_id FROM addressed WHERE fresh = 0 GROUP BY address)) AS owner
  UNION ALL
  SELECT k, CASE WHEN ok THEN map_concat(lives, map([source_id], [address])) ELSE lives END, CASE WHEN ok THEN map_concat(held, map([source_id], [ordinal])) ELSE held END,
         CASE WHEN ok THEN map_concat(map_from_entries(list_filter(map_entries(owner), lambda e: e.key IS DISTINCT FROM lives[source_id])), map([address], [source_id])) ELSE owner END
  FROM (SELECT s.k, r.lives, r.held, r.owner, s.source_id, s.address, s.ordinal, coalesce(r.owner[s.address], s.source_id) = s.source_id AS ok FROM replay r JOIN steps s ON s.k = r.k + 1)),
final AS (SELECT unnest(map_entries(held)) AS e FROM (SELECT held FROM replay ORDER BY k DESC LIMIT 1))
SELECT f.e.key AS source_id, b.url, b.ordinal FROM final f JOIN both_ b ON b.source_id = f.e.key AND b.ordinal = f.e.value""",
    "up1_upsert_last_wins": r"""WITH rows_ AS (SELECT 's' || (page_id % 97) AS source_id, regexp_replace(url, '[?#].*$', '') AS url, page_id AS ordinal FROM pages)
SELECT source_id, url, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ordinal % 3 <> 0 DESC, ordinal DESC) AS r FROM rows_) WHERE r = 1""",
    "t17_entities": f"WITH {V.FACTS}, {ENTITIES} SELECT entity_id, name, type, array_to_string(aliases, '|') AS aliases, array_to_string(regions, '|') AS regions, canonical_source_id, confidence FROM entities",
    "t17_alias_map": f"WITH {V.FACTS}, {ENTITIES} SELECT {_KEY.format('alias')} AS alias_key, max_by(name, (name, type, alias)) AS name FROM (SELECT name, type, unnest(aliases) AS alias FROM entities) GROUP BY 1",
    "up9_crosscheck": f"""WITH {V.FACTS}, own AS (SELECT *, count(*) OVER (PARTITION BY subject, predicate, object) AS many, n % 11 = 0 AS done FROM facts WHERE subject LIKE 'Part#%'),
cand AS (SELECT p_partkey AS k, 'Part#' || (p_partkey - CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END) AS title, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_type END AS category FROM part WHERE p_partkey % 5 <> 0),
met AS (SELECT own.*, k, title, CASE predicate WHEN 'belongs_to_category' THEN category WHEN 'declared_by' THEN '' END AS expected FROM own LEFT JOIN cand ON k = n),
judged AS (SELECT *, CASE WHEN NOT done THEN list_filter([CASE WHEN k IS NULL THEN 'missing_candidate' END, CASE WHEN k IS NOT NULL AND {_REASON.format('subject')} <> {_REASON.format('title')} THEN 'subject_mismatch' END,
  CASE WHEN k IS NOT NULL AND coalesce(expected, '') = '' THEN 'unsupported_or_empty_catalog_field' END, CASE WHEN k IS NOT NULL AND coalesce(expected, '') <> '' AND {_REASON.format('object')} <> {_REASON.format('expected')} THEN 'object_mismatch' END,
  CASE WHEN many > 1 THEN 'duplicate_semantic_triple' END], lambda x: x IS NOT NULL) END AS reasons FROM met)
SELECT fact_id, array_to_string(reasons, ',') AS reasons, done OR coalesce(len(reasons) = 0, false) AS verified, CASE WHEN len(reasons) = 0 THEN '{NOTE}' ELSE '' END AS notes FROM judged""",
    "up14_minimize_evidence": f"""WITH {V.FACTS}, e AS (SELECT *, '姓名 ' || {_FIELDS_SQL} || CASE WHEN n % 2 = 0 THEN '：' ELSE ' : ' END || object AS told FROM facts)
SELECT fact_id, CASE WHEN n % 13 < 10 THEN CASE subject_type WHEN 'ICH_PROJECT' THEN '项目名称' WHEN 'MUSEUM_OBJECT' THEN '文物名称' WHEN 'PERSON' THEN '姓名' ELSE '主体' END || '：' || subject || '；'
  || CASE predicate WHEN 'belongs_to_category' THEN '类别' WHEN 'made_of' THEN '质地' WHEN 'located_in' THEN '相关地区' END || '：' || object ELSE told END AS evidence_text,
  CASE WHEN n % 13 < 10 THEN 'Evidence minimized to relation-specific fields only.' ELSE '' END AS notes FROM e""",
    "up14_minimisation_report": f"""WITH {V.FACTS} SELECT count(*) AS checked, count_if(n % 13 < 10) AS updated, 0 AS remaining, (SELECT string_agg(fact_id, '|' ORDER BY fact_id) FROM (SELECT fact_id FROM facts WHERE n % 13 < 10 ORDER BY fact_id LIMIT 10)) AS sample FROM facts""",
    "t8_canonical_names": """WITH raw AS (SELECT p_partkey, (['青海', '西宁', '海东', '海北', '海北藏族自治州', '黄南', '黄南藏族自治州', '海南', '海南藏族自治州', '果洛', '果洛藏族自治州', '玉树', '玉树藏族自治州', '海西', '海西蒙古族藏族自治州',
  '酥油花', '堆绣', '盘绣', '格萨尔', '格萨（斯）尔', '青海刺绣', '藏族金属锻制技艺(藏刀锻制技艺)', '传统体育游艺与杂技', '民间音乐', '民间舞蹈', '岁时节令', '海 北', '青海。', '堆绣()', 'x y'])[p_partkey % 30 + 1] AS raw FROM part),
keyed AS (SELECT *, CASE raw WHEN '格萨（斯）尔' THEN '格萨(斯)尔' WHEN '海 北' THEN '海北' WHEN '青海。' THEN '青海' WHEN '堆绣()' THEN '堆绣' WHEN 'x y' THEN 'xy' ELSE raw END AS key FROM raw),
regions AS (SELECT *, CASE key WHEN '青海' THEN '青海省' WHEN '西宁' THEN '西宁市' WHEN '海东' THEN '海东市' WHEN '海北' THEN '海北州' WHEN '海北藏族自治州' THEN '海北州' WHEN '黄南' THEN '黄南州' WHEN '黄南藏族自治州' THEN '黄南州' WHEN '海南' THEN '海南州'
  WHEN '海南藏族自治州' THEN '海南州' WHEN '果洛' THEN '果洛州' WHEN '果洛藏族自治州' THEN '果洛州' WHEN '玉树' THEN '玉树州' WHEN '玉树藏族自治州' THEN '玉树州' WHEN '海西' THEN '海西州' WHEN '海西蒙古族藏族自治州' THEN '海西州' ELSE key END AS region FROM keyed)
SELECT p_partkey, raw, key, region, CASE key WHEN '酥油花' THEN '塔尔寺酥油花' WHEN '堆绣' THEN '湟中堆绣' WHEN '盘绣' THEN '土族盘绣' WHEN '格萨尔' THEN '格萨（斯）尔' WHEN '青海刺绣' THEN '青绣' WHEN '藏族金属锻制技艺(藏刀锻制技艺)' THEN '藏族金属锻造技艺(藏刀锻制技艺)'
  WHEN '传统体育游艺与杂技' THEN '传统体育、游艺与杂技' WHEN '民间音乐' THEN '传统音乐' WHEN '民间舞蹈' THEN '传统舞蹈' WHEN '岁时节令' THEN '民俗' ELSE region END AS entity,
  CASE raw WHEN '格萨（斯）尔' THEN '格萨(斯)尔' ELSE replace(raw, ' ', '') END AS value FROM regions""",
    "ag4_average_contributions": f"""WITH {V.FACTS}, {V.SOURCES} SELECT round(f / s, 6) AS average_facts, round(c / s, 6) AS average_chunks, round(2 * f / s, 6) AS average_questions
FROM (SELECT (SELECT count(*) FROM facts) AS f, (SELECT count(*) FROM documents WHERE source IS NOT NULL) AS c, (SELECT greatest(count(*), 1) FROM sources) AS s)""",
    "ag6_question_ratios": f"""WITH {V.FACTS} SELECT count(*) AS questions, count_if(n % 10 = 0) AS unanswerable, count_if(n % 17 = 0) AS manually_checked, round(count_if(n % 10 = 0) / count(*), 6) AS unanswerable_ratio FROM facts""",
    "ag13_distinct_values": f"""WITH {V.SOURCES} SELECT 'publisher' AS "column", count(DISTINCT publisher) AS n FROM sources WHERE publisher <> 'publisher 0' UNION ALL SELECT 'domain', count(DISTINCT split_part(url, '/', 3)) FROM sources""",
    "ag10_coverage_report": f"""WITH {V.SOURCES}, parsed AS (SELECT * FROM sources WHERE crawl_status = 'parsed'),
wanted(dimension, label, minimum) AS (VALUES ('source_levels', 'open', 2), ('source_levels', 'public', 1), ('source_levels', 'closed', 30), ('source_levels', 'none', 1), ('topics', 'zero', 4), ('topics', 'one', 50), ('topics', 'none', 1), ('regions', 'north', 1), ('regions', 'south', 9), ('regions', 'west', 1)),
labels AS (SELECT 'source_levels' AS dimension, 'open' AS label FROM parsed WHERE license_status = 'open' UNION ALL SELECT 'source_levels', 'public' FROM parsed WHERE license_status IN ('open', 'government_public') UNION ALL SELECT 'source_levels', 'closed' FROM parsed WHERE license_status = 'restricted'
  UNION ALL SELECT 'topics', CASE topic[1] WHEN 'topic 0' THEN 'zero' WHEN 'topic 1' THEN 'one' END FROM parsed UNION ALL SELECT 'regions', CASE WHEN region[1] IN ('region 0', 'region 1') THEN 'north' WHEN region[1] = 'region 2' THEN 'south' ELSE 'west' END FROM parsed),
counted AS (SELECT dimension, label, count(*) AS n FROM labels GROUP BY ALL)
SELECT dimension, label, coalesce(n, 0) AS n, minimum, greatest(minimum - coalesce(n, 0), 0) AS gap, CASE WHEN coalesce(n, 0) < minimum THEN 'below' ELSE 'met' END AS status FROM wanted LEFT JOIN counted USING (dimension, label)""",
    "ag7_violating_chunks": f"""WITH {V.SOURCES}, closed AS (SELECT source_id FROM sources WHERE license_status IN ('restricted', 'forbidden') OR release_policy IN ('local_only', 'exclude', 'metadata_and_facts_only') OR url LIKE 'https://www.s4.example.org/%')
SELECT 'chk' || doc_id AS chunk_id, 'src_' || source AS source_id FROM documents WHERE doc_id % 5 < 2 AND 'src_' || source IN (SELECT source_id FROM closed)""",
    "up15_quality_audit": f"""WITH {V.SOURCES}, latest AS (SELECT 'src_' || source AS source_id, length(coalesce(text, '')) AS length FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id % 28 DESC, length(text) DESC, doc_id) AS r FROM documents WHERE source IS NOT NULL) WHERE r = 1)
SELECT source_id, length, CASE WHEN length < 20 THEN '<20' WHEN length < 100 THEN '20-99' WHEN length < 300 THEN '100-299' WHEN length >= 300 THEN '>=300' END AS bucket,
  CASE WHEN length < 1500 AND crawl_status = 'parsed' THEN 'fetched' ELSE crawl_status END AS crawl_status,
  CASE WHEN length < 1500 AND crawl_status = 'parsed' THEN 'document quality audit: cleaned_text_chars=' || length || ' below minimum=1500' ELSE '' END AS notes FROM sources LEFT JOIN latest USING (source_id)""",
    "ag2_dataset_stats": f"""WITH {V.FACTS}, {V.SOURCES} SELECT 'relation' AS section, predicate AS value, count(*) AS n FROM facts GROUP BY 2 UNION ALL SELECT 'entity_type', subject_type, count(*) FROM facts GROUP BY 2
UNION ALL SELECT 'release_policy', release_policy, count(*) FROM sources GROUP BY 2 UNION ALL SELECT 'topic', t, count(*) FROM (SELECT unnest(topic) AS t FROM sources) GROUP BY 2
UNION ALL SELECT 'verified', CAST(verified AS VARCHAR), count(*) FROM facts GROUP BY 2 UNION ALL SELECT 'manual', CAST(manual_checked AS VARCHAR), count(*) FROM facts GROUP BY 2""",
    "ag3_contributions": f"""WITH {V.FACTS}, {V.SOURCES} SELECT source_id, coalesce(f.n, 0) AS facts, coalesce(c.n, 0) AS chunks FROM sources
LEFT JOIN (SELECT evidence_source_id AS source_id, count(*) AS n FROM facts GROUP BY 1) f USING (source_id) LEFT JOIN (SELECT 'src_' || source AS source_id, count(*) AS n FROM documents GROUP BY 1) c USING (source_id)""",
    "ag5_chunk_lengths": "SELECT count(*) AS n, round(avg(length(coalesce(text, ''))), 6) AS mean_length, median(length(coalesce(text, ''))) AS median_length FROM documents WHERE source IS NOT NULL",
    "ag7_restricted_audit": f"""WITH {V.SOURCES}, closed AS (SELECT source_id FROM sources WHERE license_status IN ('restricted', 'forbidden') OR release_policy IN ('local_only', 'exclude', 'metadata_and_facts_only') OR url LIKE 'https://www.s4.example.org/%'),
met AS (SELECT CASE WHEN doc_id % 5 < 2 THEN 'open' ELSE 'synthetic' END AS kind FROM documents WHERE 'src_' || source IN (SELECT source_id FROM closed))
SELECT (SELECT count(*) FROM closed) AS restricted_sources, count(*) AS chunks, count_if(kind = 'synthetic') AS synthetic, count_if(kind = 'open') AS violations, count_if(kind = 'open') = 0 AS passed FROM met""",
    "ag8_tier_assessment": f"""WITH {V.FACTS}, {V.SOURCES}, metrics AS (SELECT 'facts' AS metric, count(*) AS value FROM facts UNION ALL SELECT 'sources', count(*) FROM sources UNION ALL SELECT 'chunks', count(*) FROM documents WHERE source IS NOT NULL),
targets(tier, metric, low, high) AS (VALUES {", ".join(map(str, TARGETS))}),
met AS (SELECT tier, metric, low, high, value, CASE WHEN value < low THEN 'below' WHEN value > high THEN 'above' ELSE 'in_range' END AS status FROM targets JOIN metrics USING (metric))
SELECT *, bool_and(status <> 'below') OVER (PARTITION BY tier) AS tier_passed FROM met""",
    "ag12_coverage_gaps": f"""WITH {V.SOURCES}, wanted(label, minimum) AS (VALUES ('zero', 4), ('one', 50), ('none', 1)),
counted AS (SELECT CASE topic[1] WHEN 'topic 0' THEN 'zero' WHEN 'topic 1' THEN 'one' END AS label, count(*) AS n FROM sources WHERE crawl_status = 'parsed' GROUP BY 1)
SELECT label, coalesce(n, 0) AS n, minimum, greatest(minimum - coalesce(n, 0), 0) AS gap, CASE WHEN coalesce(n, 0) < minimum THEN 'below' ELSE 'met' END AS status FROM wanted LEFT JOIN counted USING (label)""",
    "ag11_coverage_matrix": f"""WITH {V.SOURCES}, grid AS (SELECT * FROM (VALUES ('north'), ('south'), ('west')) r(region), (VALUES ('zero'), ('one'), ('none')) c(topic)),
counted AS (SELECT CASE WHEN region[1] IN ('region 0', 'region 1') THEN 'north' WHEN region[1] = 'region 2' THEN 'south' ELSE 'west' END AS region, CASE topic[1] WHEN 'topic 0' THEN 'zero' WHEN 'topic 1' THEN 'one' END AS topic, count(*) AS n
  FROM sources WHERE crawl_status = 'parsed' GROUP BY 1, 2)
SELECT region, topic, coalesce(n, 0) AS n FROM grid LEFT JOIN counted USING (region, topic)""",
    "ag14_metadata_completeness": """SELECT t.col AS "column", t.n, round(t.n / total, 6) AS ratio FROM (SELECT count(*) AS total, count_if(lang <> '') AS a, count_if(source <> '') AS b, count_if(n_chars > 1000) AS c FROM documents), LATERAL (VALUES ('lang', a), ('source', b), ('long', c)) t(col, n)""",
    "va4_orphans": f"""WITH {V.FACTS}, {V.SOURCES} SELECT 'fact_source' AS "check", fact_id AS record_id, evidence_source_id AS detail FROM facts WHERE evidence_source_id NOT IN (SELECT source_id FROM sources WHERE release_policy <> 'local_only')
UNION ALL SELECT 'label_document', CAST(doc_id AS VARCHAR), CAST(doc_id AS VARCHAR) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 10 <> 3)""",
    "va3_duplicates": f"""WITH {V.FACTS} SELECT 'text' AS "check", sha256(text) AS value, count(*) AS n FROM documents GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'host', {_HOST}, count(*) FROM pages GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'subject_predicate', subject || ' | ' || predicate, count(*) FROM facts GROUP BY 2 HAVING count(*) > 1""",
    "va2_schema": """SELECT CAST(doc_id AS VARCHAR) AS record_id, rule FROM (SELECT doc_id, unnest(list_filter([CASE WHEN coalesce(lang NOT IN ('en', 'de'), true) THEN 'lang_domain' END, CASE WHEN coalesce(n_chars <> length(text), true) THEN 'length_agrees' END,
  CASE WHEN coalesce(n_chars < 500, true) THEN 'long_enough' END, CASE WHEN coalesce(NOT regexp_matches(source, '^src[0-9]$'), true) THEN 'source_known' END], lambda x: x IS NOT NULL)) AS rule FROM documents)""",
    "va5_personal_fields": f"""WITH {V.FACTS} SELECT fact_id, '姓名 ' || {_FIELDS_SQL} || CASE WHEN n % 2 = 0 THEN '：' ELSE ' : ' END || object AS evidence_text FROM facts WHERE n % 13 < 10""",
    "tk10_similar_names": """WITH names AS (SELECT DISTINCT p_type || ' ' || p_brand AS name FROM part),
met AS (SELECT a.name, b.name AS match, round(1 - levenshtein(a.name, b.name) / greatest(length(a.name), length(b.name)), 6) AS score FROM names a JOIN names b ON a.name <> b.name AND abs(length(a.name) - length(b.name)) <= 0.1 * greatest(length(a.name), length(b.name)))
SELECT name, match, score FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, match) AS r FROM met WHERE score >= 0.9) WHERE r <= 5""",
}
