"""Registered queries for sources, page text, releases and incremental collection, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import qa as Q
from evidentia.operators.merge import keep_last, preserve_state
from evidentia.sources import discovery, html, jsonl, release
from evidentia.plans import views as V
from evidentia.plans.shared import shared_dir
from evidentia.streaming import collect as S

BASE = "https://www.example.org/item"


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey").cast("string"))


def _payloads(rows: DataFrame, item) -> DataFrame:
    """Catalog payloads of a hundred items at most, later ones with higher ordinals."""
    grouped = rows.groupBy(F.floor(F.col("p_partkey") / 100).alias("ordinal")).agg(F.array_sort(F.collect_list(item)).alias("list"))
    return grouped.select("ordinal", F.to_json(F.struct("list")).alias("payload"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    item = F.struct(
        (c("p_partkey") % 1500).cast("string").alias("id"), F.concat(F.lit("Ⅰ-"), "k").alias("num"), c("k").alias("auto_id"), F.when(c("p_partkey") % 9 != 0, F.concat(F.lit(" "), "p_name")).alias("title"),
        c("p_type").alias("type"), F.concat("p_brand", F.lit("<br/>x")).alias("rx_time"), F.when(c("p_partkey") % 4 == 0, "青海省").when(c("p_partkey") % 4 == 1, "西宁市").alias("province"), c("p_brand").alias("unit"), F.concat(F.lit("p"), "k").alias("project"),
    )
    return _payloads(_part(spark, sf_dir), item)


def _flat(c: DataFrame, *keys: str) -> DataFrame:
    return c.select("candidate_id", "source_id", "title", "url", "domain", F.array_join("region", "|").alias("region"), F.array_join("topic", "|").alias("topic"), *(F.element_at("catalog_metadata", F.lit(k)).alias(k) for k in keys))


def project_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(discovery.project_candidates(_catalog(spark, sf_dir), BASE), "project_sequence", "publication_batch", "applicant")


def inheritor_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(discovery.inheritor_candidates(_catalog(spark, sf_dir), BASE), "project", "applicant")


def exhibit_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    item = F.struct(c("k").alias("exhibit_id"), c("p_name").alias("exhibit_name"), F.lit("7").alias("museum_id"), F.lit("M").alias("museum_name"), c("p_type").alias("cate_name"), F.when(c("p_partkey") % 3 == 0, "u").alias("three_url"))
    lists = _part(spark, sf_dir).groupBy(F.floor(c("p_partkey") / 100).alias("ordinal")).agg(F.array_sort(F.collect_list(item)).alias("list"))
    payloads = lists.select("ordinal", F.to_json(F.struct(F.lit(1).alias("status"), F.struct(F.size("list").alias("count"), "list").alias("data"))).alias("payload"))
    return _flat(discovery.exhibit_candidates(payloads, BASE, "M"), "has_3d", "category")


def exhibit_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    data = F.struct(c("k").alias("exhibit_id"), F.when(c("p_partkey") % 8 != 0, c("p_name")).alias("exhibit_name"), F.when(c("p_partkey") % 7 == 0, "N").otherwise("M").alias("museum_name"), c("p_type").alias("cate_name"), F.concat(F.lit("<p>a</p><p>"), "p_brand", F.lit("</p>")).alias("content"))
    payloads = _part(spark, sf_dir).select(c("p_partkey").alias("ordinal"), F.when(c("p_partkey") % 11 == 0, "x").otherwise(c("k")).alias("expected_id"), F.to_json(F.struct(F.when(c("p_partkey") % 13 == 0, 0).otherwise(1).alias("status"), data.alias("data"))).alias("payload"))
    return discovery.exhibit_details(payloads, "M")


def best_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discovery.project_candidates(_catalog(spark, sf_dir), BASE)
    return discovery.best_by_title(found, F.asc("url")).select("source_id", "title")


def candidate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-seeding keeps the state of sources whose collection has begun."""
    fresh = discovery.to_sources(discovery.project_candidates(_catalog(spark, sf_dir), BASE))
    n = F.regexp_extract("source_id", r"(\d+)$", 1).cast("int")
    old = fresh.filter(n % 3 == 0).withColumns({"crawl_status": F.when(n % 2 == 0, "parsed").otherwise("pending"), "notes": F.lit("seen"), "title": F.lit("old title")})
    return preserve_state(fresh, old, ["crawl_status", "notes"], ["title"]).select("source_id", "title", "crawl_status", "notes")


def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.clean_pages(V.table(spark, sf_dir, "pages"), "page_id", "html")


def _table_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = _part(spark, sf_dir)
    row = lambda *cells: F.concat(F.lit("<tr>"), *(x for c in cells for x in (F.lit("<td>"), c, F.lit("</td>"))), F.lit("</tr>"))
    body = F.concat(F.lit("<html><body><table>"), row(F.lit("项目名称"), F.lit("类别"), F.lit("保护单位"), F.lit("备注")), row(F.concat(F.lit("项目名称 part"), "k"), F.col("p_type"), F.concat("p_brand", F.lit("、Mill"), F.col("p_size").cast("string")), F.lit("x")), row(F.lit("short"), F.lit("row")), F.lit("</table></body></html>"))
    pages = p.select(F.concat(F.lit("src_p"), "k").alias("source_id"), body.alias("html"))
    sources = p.filter("p_partkey % 10 <> 4").select(F.concat(F.lit("src_p"), "k").alias("source_id"), F.lit("t").alias("title"), F.lit("example.org").alias("domain"), F.lit("").alias("province"), F.array().cast("array<string>").alias("region"), F.lit("u").alias("url"))
    return pages, sources


def table_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.table_facts(*_table_pages(spark, sf_dir)).select("fact_id", "subject", "predicate", "object", "object_type", "evidence_source_id", "evidence_text")


def text_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir)
    text = F.concat(F.lit("前言。项目名称：part"), "k", F.lit("；备注；类别: "), "p_type", F.lit("\n其他 名称 : second"), "k", F.lit(" \n 项目类别："), "p_brand", F.lit("；"))
    return html.text_facts(p.select(F.concat(F.lit("src_p"), "k").alias("source_id"), text.alias("text"))).select("fact_id", "subject", "object", "evidence_source_id", "evidence_text")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch/{uuid.uuid4().hex}"


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.facts(spark, sf_dir).select("fact_id", "subject", "predicate", "object", "verified")
    path = _scratch(spark)
    jsonl.write_jsonl(rows, path, "fact_id")
    return jsonl.read_jsonl(spark, path, rows.schema)


def release_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"facts": V.facts(spark, sf_dir), "sources": V.sources(spark, sf_dir), "qa": Q.regional(Q.publishable(V.facts(spark, sf_dir)), None)}
    path = _scratch(spark)
    manifest = release.package(tables, path)
    problems = release.check_package(spark, path, manifest).groupBy("name").agg(F.count("*").alias("n"))
    return manifest.groupBy("name").agg(F.max("rows").alias("rows")).join(problems, "name", "left").select("name", "rows", F.coalesce("n", F.lit(0)).alias("problems"))


def incremental_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = V.table(spark, sf_dir, "pages").select((F.col("page_id") % 83).alias("slot"), "url", F.col("page_id").alias("ordinal"))
    path = _scratch(spark)
    for turn in range(3):
        pages.filter(F.col("ordinal") % 3 == turn).repartition(2).write.mode("append").parquet(f"{path}/landing")
    done = S.collect(spark, f"{path}/landing", pages.schema, f"{path}/table", "slot", "ordinal", f"{path}/checkpoint")
    pages.filter("ordinal % 50 = 0").withColumns({"ordinal": F.col("ordinal") + 1000000, "url": F.lit("again")}).repartition(2).write.mode("append").parquet(f"{path}/landing")
    done = S.collect(spark, f"{path}/landing", pages.schema, f"{path}/table", "slot", "ordinal", f"{path}/checkpoint")
    return keep_last(done, ["slot"], "ordinal").select("slot", "url")


def windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = V.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = S.windowed_counts(events, "ts", "event_type")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def tokens_and_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String functions over facts: notes, personal fields, values and marks."""
    f = V.facts(spark, sf_dir).withColumn("notes", F.concat(F.lit("a=1; source="), "evidence_source_id", F.lit("; z=9")))
    return f.select("fact_id", T.note_value(F.col("notes"), "source").alias("value"), T.with_note(F.col("notes"), "z=9").alias("same"), T.with_note(F.col("notes"), "new").alias("more"), F.sha2(T.full_width_marks(F.concat("object", F.lit(",;:?!"))), 256).alias("marks"))


QUERIES = {
    "sc10_project_candidates": project_candidates,
    "sc12_inheritor_candidates": inheritor_candidates,
    "sc19_exhibit_candidates": exhibit_candidates,
    "sc20_exhibit_details": exhibit_details,
    "w3_best_by_title": best_by_title,
    "pf18_candidate_sources": candidate_sources,
    "t5_clean_html": clean_html,
    "t10_table_facts": table_facts,
    "t11_text_facts": text_facts,
    "sc1_jsonl_roundtrip": jsonl_roundtrip,
    "sk4_release_manifest": release_manifest,
    "st1_incremental_collect": incremental_collect,
    "st_windowed_counts": windowed_counts,
    "t19_notes": tokens_and_notes,
}

_ITEMS = """items AS (SELECT p_partkey // 100 AS ordinal, CAST(p_partkey % 1500 AS VARCHAR) AS id, 'Ⅰ-' || p_partkey AS num, CAST(p_partkey AS VARCHAR) AS auto_id, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS title, p_type AS type, p_brand || ' x' AS batch,
  CASE p_partkey % 4 WHEN 0 THEN '青海省' WHEN 1 THEN '西宁市' ELSE '' END AS province, p_brand AS unit, 'p' || p_partkey AS project FROM part),
kept AS (SELECT * FROM (SELECT *, 'https://www.example.org/item/' || id || '.html' AS url, row_number() OVER (PARTITION BY id ORDER BY ordinal DESC, num DESC) AS r FROM items WHERE title IS NOT NULL) WHERE r = 1)"""
_REGION = "CASE WHEN {0} NOT IN ('', '青海省') THEN '青海省|' || {0} ELSE '青海省' END"
ORACLE_SQL = {
    "sc10_project_candidates": f"WITH {_ITEMS} SELECT 'candidate_' || substr(sha256(url), 1, 12) AS candidate_id, 'src_ihchina_' || id AS source_id, title, url, 'example.org' AS domain, {_REGION.format('province')} AS region, '非遗|' || type AS topic, auto_id AS project_sequence, batch AS publication_batch, province AS applicant FROM kept",
    "sc12_inheritor_candidates": f"WITH {_ITEMS} SELECT 'candidate_' || substr(sha256(url), 1, 12) AS candidate_id, 'src_ihchina_inheritor_' || id AS source_id, title, url, 'example.org' AS domain, {_REGION.format('applicant')} AS region, '非遗|代表性传承人|' || type AS topic, project, applicant FROM (SELECT *, coalesce(nullif(province, ''), unit) AS applicant FROM kept)",
    "sc19_exhibit_candidates": """SELECT 'candidate_' || substr(sha256(url), 1, 12) AS candidate_id, 'src_tibetan_museum_exhibit_' || p_partkey AS source_id, p_name AS title, url, 'example.org' AS domain, '青海省|西宁市' AS region, '博物馆与文化场馆|民族文化|馆藏文物|' || p_type AS topic,
  CASE WHEN p_partkey % 3 = 0 THEN 'true' ELSE 'false' END AS has_3d, p_type AS category FROM (SELECT *, 'https://www.example.org/item?exhibit_id=' || p_partkey || '&p=w' AS url FROM part)""",
    "sc20_exhibit_details": """SELECT ordinal, exhibit_id, CASE WHEN problem IS NULL THEN text END AS text, problem FROM (SELECT p_partkey AS ordinal, CAST(p_partkey AS VARCHAR) AS exhibit_id,
  '文物名称：' || p_name || chr(10) || '馆藏机构：M' || chr(10) || '文物类别：' || p_type || chr(10) || '馆藏说明：a' || chr(10) || p_brand AS text,
  CASE WHEN p_partkey % 13 = 0 THEN 'unsuccessful status' WHEN p_partkey % 11 = 0 THEN 'exhibit id mismatch' WHEN p_partkey % 7 = 0 THEN 'unexpected owner' WHEN p_partkey % 8 = 0 THEN 'missing name' END AS problem FROM part)""",
    "w3_best_by_title": f"WITH {_ITEMS} SELECT source_id, title FROM (SELECT 'src_ihchina_' || id AS source_id, title, row_number() OVER (PARTITION BY replace(title, ' ', '') ORDER BY url) AS r FROM kept) WHERE r = 1".replace("AS r FROM kept) WHERE r = 1", "AS r1 FROM kept) WHERE r1 = 1"),
    "pf18_candidate_sources": f"WITH {_ITEMS} SELECT 'src_ihchina_' || id AS source_id, CASE WHEN k % 6 = 0 THEN 'old title' ELSE title END AS title, CASE WHEN k % 6 = 0 THEN 'parsed' ELSE 'pending' END AS crawl_status, CASE WHEN k % 3 = 0 THEN 'seen' ELSE '' END AS notes FROM (SELECT *, CAST(id AS INT) AS k FROM kept)",
    "t10_table_facts": """WITH cells AS (SELECT 'part' || p_partkey AS subject, 'src_p' || p_partkey AS src, * FROM part WHERE p_partkey % 10 <> 4),
f AS (SELECT subject, 'belongs_to_category' AS predicate, replace(p_type, ' ', '') AS object, 'CATEGORY' AS object_type, src, '类别：' || p_type AS told FROM cells UNION ALL SELECT subject, 'protected_by', replace(p_brand, ' ', ''), 'ORGANIZATION', src, '保护单位：' || p_brand FROM cells
  UNION ALL SELECT subject, 'protected_by', 'Mill' || p_size, 'ORGANIZATION', src, '保护单位：Mill' || p_size FROM cells)
SELECT 'fact_' || substr(sha256(subject || chr(0) || predicate || chr(0) || object || chr(0) || src), 1, 12) AS fact_id, subject, predicate, object, object_type, src AS evidence_source_id, '项目名称：' || subject || '；' || told AS evidence_text FROM f""",
    "t11_text_facts": """WITH m AS (SELECT 'part' || p_partkey AS subject, replace(p_type, ' ', '') AS object, 'src_p' || p_partkey AS src, '项目名称：part' || p_partkey || '；备注；类别: ' || p_type AS e FROM part
  UNION ALL SELECT 'second' || p_partkey, replace(p_brand, ' ', ''), 'src_p' || p_partkey, '名称 : second' || p_partkey || ' 项目类别：' || p_brand FROM part)
SELECT 'fact_' || substr(sha256(subject || chr(0) || 'belongs_to_category' || chr(0) || object || chr(0) || src), 1, 12) AS fact_id, subject, object, src AS evidence_source_id, substr(e, 1, 300) AS evidence_text FROM m""",
    "sc1_jsonl_roundtrip": f"WITH {V.FACTS} SELECT fact_id, subject, predicate, object, verified FROM facts",
    "sk4_release_manifest": f"""WITH {V.FACTS}, {V.SOURCES}, g AS (SELECT object FROM facts WHERE verified AND confidence IN ('high', 'medium') AND predicate = 'located_in' GROUP BY object HAVING count(DISTINCT subject) <= 5)
SELECT 'facts' AS name, count(*) AS rows, 0 AS problems FROM facts UNION ALL SELECT 'sources', count(*), 0 FROM sources UNION ALL SELECT 'qa', count(*), 0 FROM g""",
    "st1_incremental_collect": """SELECT slot, url FROM (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY ordinal DESC) AS r FROM (SELECT page_id % 83 AS slot, url, page_id AS ordinal FROM pages UNION ALL SELECT page_id % 83, 'again', page_id + 1000000 FROM pages WHERE page_id % 50 = 0)) WHERE r = 1""",
    "st_windowed_counts": "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "t19_notes": f"WITH {V.FACTS}, n AS (SELECT *, 'a=1; source=' || evidence_source_id || '; z=9' AS note FROM facts) SELECT fact_id, evidence_source_id AS value, note AS same, note || '; new' AS more, sha256(object || '，；：？！') AS marks FROM n",
}
