"""Registered queries for reviewed catalogs and collected details, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import catalogs as K
from evidentia.plans import views as V


def _part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey").cast("string"))


def _catalog(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ten reviewed catalogs; some have a flaw."""
    c = F.col
    rows = _part(spark, sf_dir).select(
        F.concat(F.lit("r"), (c("p_partkey") % 10).cast("string")).alias("review_id"), (F.floor(c("p_partkey") / 10) + 1 + F.when(c("p_partkey") == 3, 900000).otherwise(0)).cast("int").alias("sequence"), F.when(c("p_partkey") % 4 == 0, c("p_partkey")).cast("int").alias("source_sequence"),
        F.when(c("p_partkey") % 10 == 5, F.lit("same")).otherwise(c("k")).alias("project_number"), F.concat(F.lit("project"), c("k")).alias("project_name"), F.lit(None).cast("string").alias("canonical_project_name"),
        c("p_type").alias("category"), c("p_brand").alias("circulation_area"), F.when(c("p_partkey") % 3 == 0, "省级").alias("level"), F.array(F.concat(F.lit("person"), (c("p_partkey") % 7).cast("string")), F.concat(F.lit("person"), c("p_size").cast("string"))).alias("inheritors"),
    )
    header = rows.groupBy("review_id").agg(F.count("*").cast("int").alias("expected_rows"))
    n = F.substring("review_id", 2, 1).cast("int")
    header = header.select("review_id", F.concat(F.lit("src_"), "review_id").alias("source_id"), (F.col("expected_rows") + (n == 1).cast("int")).alias("expected_rows"), F.lit("市级").alias("level"), F.when(n.isin(2, 6), "proposed").otherwise("final").alias("publication_status"), F.when(n == 6, "concept").alias("proposed_concept"), F.lit("b1").alias("batch"))
    return rows, header


def catalog_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.catalog_problems(*_catalog(spark, sf_dir))


def catalog_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.reviewed_catalog_facts(*_catalog(spark, sf_dir)).select("fact_id", "subject", "predicate", "object", "object_type", "evidence_source_id", "evidence_text", "manual_checked")


def _people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reviewed inheritor catalogs of customers; one has a flaw."""
    c = F.col
    s = V.table(spark, sf_dir, "customer").withColumn("k", c("c_custkey").cast("string"))
    rows = s.select(F.concat(F.lit("i"), (c("c_custkey") % 6).cast("string")).alias("review_id"), (F.floor(c("c_custkey") / 6) + 1).cast("int").alias("sequence"), F.concat(F.lit("项目 "), "c_mktsegment").alias("project_name"), c("c_name").alias("person_name"), F.when(c("c_custkey") % 4 == 0, F.lit("省级")).alias("project_level"))
    header = rows.groupBy("review_id").agg(F.count("*").cast("int").alias("expected_rows"))
    n = F.substring("review_id", 2, 1).cast("int")
    header = header.select("review_id", F.concat(F.lit("src_"), "review_id").alias("source_id"), (F.col("expected_rows") + (n == 2).cast("int")).alias("expected_rows"), F.lit("b2").alias("batch"))
    return rows, header


def inheritor_catalog_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.reviewed_inheritor_facts(*_people(spark, sf_dir)).select("fact_id", "subject", "predicate", "object", "evidence_text")


def inheritor_catalog_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.inheritor_catalog_problems(*_people(spark, sf_dir))


def catalog_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of reviewed catalogs whose attachments are the pages' addresses."""
    p = V.table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    header = p.select(
        F.concat(F.lit("r"), n).alias("review_id"), F.concat(F.lit("src_"), n).alias("source_id"), F.lit("t").alias("title"), F.lit("p").alias("publisher"), F.col("url").alias("attachment_url"), F.lit("u").alias("parent_page_url"), F.lit("project").alias("catalog_kind"),
        F.array(F.lit("青海省")).alias("region"), F.array(F.lit("非遗")).alias("topic"), F.lit("2024-05-06").alias("reviewed_at"), F.sha2("url", 256).alias("attachment_sha256"),
    )
    return K.catalog_sources(header).select("source_id", "url", "domain", "release_policy", "crawl_status", "content_sha256", "notes")


def attachment_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir)
    header = p.select(F.col("k").alias("review_id"), F.col("p_name").alias("raw_path"), F.sha2("k", 256).alias("attachment_sha256")).dropDuplicates(["raw_path"])
    files = p.filter("p_partkey % 3 <> 0").groupBy(F.col("p_name").alias("path")).agg(F.lit("other").alias("sha256"))
    return K.attachment_problems(header, files).groupBy("problem").agg(F.count("*").alias("n"))


def museum_review_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _part(spark, sf_dir).select(F.concat(F.lit("src_tibetan_museum_exhibit_"), F.when(F.col("p_partkey") % 50 == 0, F.lit("7")).otherwise(F.col("k"))).alias("source_id"), F.col("p_partkey").cast("int").alias("exhibit_id"))
    return K.review_problems(p, p.count() + 1, 4)


def _inheritors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = F.col
    s = V.table(spark, sf_dir, "customer").withColumn("k", c("c_custkey").cast("string"))
    candidates = s.select(F.concat(F.lit("src_"), "k").alias("source_id"), c("c_name").alias("person"), F.concat(F.lit("project"), "k").alias("project"), c("c_mktsegment").alias("category"), F.when(c("c_custkey") % 7 != 0, "省").alias("applicant"), F.lit("Ⅰ-1").alias("project_number"), F.when(c("c_custkey") % 2 == 0, "族").otherwise("").alias("ethnic_group"))
    text = F.concat("c_name", F.lit(" project"), "k", F.lit(" "), F.when(c("c_custkey") % 5 != 0, c("c_mktsegment")).otherwise("-"), F.lit(" 省 族"))
    return candidates, s.filter("c_custkey % 11 <> 0").select(F.concat(F.lit("src_"), "k").alias("source_id"), F.when(c("c_custkey") % 13 == 0, "other").otherwise(F.concat("c_name", F.lit(" - site"))).alias("title"), text.alias("text"))


def inheritor_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.inheritor_facts(*_inheritors(spark, sf_dir))[0].select("fact_id", "subject", "predicate", "object")


def inheritor_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.inheritor_facts(*_inheritors(spark, sf_dir))[1].select("source_id", F.array_join("reasons", ",").alias("reasons"))


def _museum(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    c = F.col
    p = _part(spark, sf_dir).withColumn("source_id", F.concat(F.lit("src_"), "k"))
    candidates = p.select("source_id", c("p_name").alias("title"), c("k").alias("url"), c("k").alias("exhibit_id"), F.lit("M").alias("museum"), c("p_type").alias("category"), F.when(c("p_partkey") % 4 == 0, "").otherwise("唐").alias("period"), c("p_brand").alias("texture"))
    sources = p.filter("p_partkey % 9 <> 0").select("source_id", F.when(c("p_partkey") % 17 == 0, "x").otherwise(c("k")).alias("url"), F.when(c("p_partkey") % 6 == 0, "failed").otherwise("parsed").alias("crawl_status"), F.sha2("k", 256).alias("content_sha256"))
    details = p.filter("p_partkey % 10 <> 0").select("source_id", F.when(c("p_partkey") % 19 == 0, "y").otherwise(F.sha2("k", 256)).alias("sha256"), c("p_name").alias("d_title"), F.lit("M").alias("d_museum"), F.when(c("p_partkey") % 8 == 0, "other").otherwise(c("p_type")).alias("d_category"), F.when(c("p_partkey") % 4 == 0, "").otherwise("唐").alias("d_period"), c("p_brand").alias("d_texture"))
    return candidates, sources, details


def museum_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.museum_facts(*_museum(spark, sf_dir))[0].select("fact_id", "subject", "predicate", "object", "evidence_text")


def museum_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.museum_facts(*_museum(spark, sf_dir))[1].select("source_id", F.array_join("reasons", ",").alias("reasons"))


def _review(spark: SparkSession, sf_dir: str, flawed: bool) -> tuple[DataFrame, DataFrame]:
    candidates, sources, details = _museum(spark, sf_dir)
    facts = K.museum_facts(candidates, sources, details)[0].withColumns({"verified": F.lit(True), "confidence": F.lit("high"), "manual_checked": F.lit(False), "notes": F.lit("")})
    subjects = facts.filter("predicate = 'held_by'").select(F.col("evidence_source_id").alias("source_id"), F.col("subject").alias("name"))
    n = F.col("exhibit_id").cast("int")
    review = candidates.filter((n % 4 != 0) & (n % 3 == 1)).join(subjects, "source_id").select("source_id", "name", "category", "period", "museum", F.when(F.lit(flawed) & (n == 1), "wood").otherwise(F.col("texture")).alias("material"))
    return K.mark_reviewed(facts, sources, review, "m1", "2024-05-06")


def review_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _review(spark, sf_dir, False)[0].select("fact_id", "manual_checked", "notes")


def review_cancelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, issues = _review(spark, sf_dir, True)
    return facts.agg(F.count_if("manual_checked").alias("marked")).join(issues.agg(F.count("*").alias("issues")))


QUERIES = {
    "pf19_catalog_problems": catalog_problems,
    "t16_catalog_facts": catalog_facts,
    "t16_inheritor_catalog_facts": inheritor_catalog_facts,
    "pf19_inheritor_catalog_problems": inheritor_catalog_problems,
    "pf16_catalog_sources": catalog_sources,
    "pf21_attachment_problems": attachment_problems,
    "pf20_museum_review_problems": museum_review_problems,
    "t14_inheritor_facts": inheritor_facts,
    "t14_inheritor_issues": inheritor_issues,
    "t15_museum_facts": museum_facts,
    "t15_museum_issues": museum_issues,
    "up10_review_marks": review_marks,
    "up10_review_cancelled": review_cancelled,
}

_ID = "'fact_' || substr(sha256(subject || chr(0) || predicate || chr(0) || object || chr(0) || src), 1, 12)"
_BARE = "replace({0}, ' ', '')"
_GOOD_C = "c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 5 <> 0"
_MUSEUM = f"""m AS (SELECT *, count(*) OVER (PARTITION BY p_name) AS many FROM part),
judged AS (SELECT *, p_partkey % 9 <> 0 AND p_partkey % 10 <> 0 AND p_partkey % 19 <> 0 AS hashed FROM m),
good AS (SELECT *, CASE WHEN many > 1 THEN p_name || '（展品ID：' || p_partkey || '）' ELSE p_name END AS subject, 'src_' || p_partkey AS src, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '唐' END AS period
  FROM judged WHERE hashed AND p_partkey % 8 <> 0 AND p_partkey % 6 <> 0 AND p_partkey % 17 <> 0),
said AS (SELECT *, '展品ID：' || p_partkey || '；文物名称：' || p_name || '；馆藏机构：M；文物类别：' || p_type || '；年代：' || CASE WHEN period = '' THEN '未标注' ELSE period END || '；质地：' || p_brand AS evidence_text FROM good),
rel AS (SELECT p_partkey, subject, 'held_by' AS predicate, 'M' AS object, src, evidence_text FROM said UNION ALL SELECT p_partkey, subject, 'made_of', p_brand, src, evidence_text FROM said
  UNION ALL SELECT p_partkey, subject, 'belongs_to_category', p_type, src, evidence_text FROM said UNION ALL SELECT p_partkey, subject, 'created_in_period', period, src, evidence_text FROM said WHERE period <> '')"""
ORACLE_SQL = {
    "pf19_catalog_problems": """SELECT review_id, problem FROM (
  SELECT 'r1' AS review_id, 'row count' AS problem UNION ALL SELECT 'r3', 'sequence' UNION ALL SELECT 'r2', 'proposed concept'
  UNION ALL SELECT 'r5', 'project number' WHERE (SELECT count(*) FROM part WHERE p_partkey % 10 = 5) > 1
  UNION ALL SELECT DISTINCT 'r' || (p_partkey % 10), 'inheritors' FROM part WHERE p_partkey % 7 = p_size)""",
    "t16_catalog_facts": f"""WITH q AS (SELECT *, 'project' || p_partkey AS subject, 'src_r' || (p_partkey % 10) AS src, p_partkey % 10 IN (2, 6) AS proposed, p_partkey // 10 + 1 + CASE WHEN p_partkey = 3 THEN 900000 ELSE 0 END AS sequence, CASE WHEN p_partkey % 3 = 0 THEN '省级' ELSE '市级' END AS level FROM part),
p AS (SELECT *, '人工核验官方材料表格第' || sequence || '条（源表序号' || CASE WHEN p_partkey % 4 = 0 THEN p_partkey ELSE sequence END || '）：项目编号：' || CASE WHEN p_partkey % 10 = 5 THEN 'same' ELSE CAST(p_partkey AS VARCHAR) END || '；项目名称：' || subject || '；项目类别：' || p_type || '；流传地区：' || p_brand
  || '；项目级别：' || level || '；传承人：person' || (p_partkey % 7) || '、person' || p_size || '；名录批次：b1' AS evidence_text FROM q),
f AS (SELECT subject, 'belongs_to_category' AS predicate, {_BARE.format("p_type")} AS object, 'CATEGORY' AS object_type, src, evidence_text FROM p UNION SELECT subject, 'related_to_concept', 'concept', 'CONCEPT', src, evidence_text FROM p WHERE p_partkey % 10 = 6
  UNION SELECT subject, 'located_in', {_BARE.format("p_brand")}, 'REGION', src, evidence_text FROM p WHERE NOT proposed UNION SELECT subject, 'has_level', level, 'CONCEPT', src, evidence_text FROM p WHERE NOT proposed
  UNION SELECT subject, 'inherited_by', 'person' || (p_partkey % 7), 'PERSON', src, evidence_text FROM p WHERE NOT proposed UNION SELECT subject, 'inherited_by', 'person' || p_size, 'PERSON', src, evidence_text FROM p WHERE NOT proposed)
SELECT {_ID} AS fact_id, subject, predicate, object, object_type, src AS evidence_source_id, evidence_text, true AS manual_checked FROM f""",
    "t16_inheritor_catalog_facts": f"""WITH c AS (SELECT *, '项目' || {_BARE.format("c_mktsegment")} AS subject, 'src_i' || (c_custkey % 6) AS src, c_custkey // 6 + 1 AS sequence, CASE WHEN c_custkey % 4 = 0 THEN '省级' END AS level FROM customer),
f AS (SELECT subject, 'inherited_by' AS predicate, {_BARE.format("c_name")} AS object, src, '人工核验官方材料第' || sequence || '条：项目名称：项目 ' || c_mktsegment || '；代表性传承人：' || c_name || coalesce('；项目级别：' || level, '') || '；名录批次：b2' AS evidence_text FROM c
  UNION ALL SELECT subject, 'has_level', level, src, '人工核验官方材料第' || sequence || '条：项目名称：项目 ' || c_mktsegment || '；项目级别：' || level || '；代表性传承人：' || c_name || '；名录批次：b2' FROM c WHERE level IS NOT NULL)
SELECT {_ID} AS fact_id, subject, predicate, object, min(evidence_text) AS evidence_text FROM f GROUP BY subject, predicate, object, src""",
    "pf19_inheritor_catalog_problems": "SELECT 'i2' AS review_id, 'row count' AS problem",
    "pf16_catalog_sources": r"""SELECT 'src_' || page_id AS source_id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\.', '') AS domain, 'metadata_and_facts_only' AS release_policy, 'parsed' AS crawl_status, sha256(url) AS content_sha256,
  'Manually reviewed official project catalog attachment; review_id=r' || page_id || '; parent_page=u; raw attachment is not released.' AS notes FROM pages""",
    "pf21_attachment_problems": """SELECT problem, count(*) AS n FROM (SELECT p_name, CASE WHEN bool_or(p_partkey % 3 <> 0) THEN 'sha256 mismatch' ELSE 'missing' END AS problem FROM part GROUP BY p_name) GROUP BY problem""",
    "pf20_museum_review_problems": """SELECT NULL AS source_id, 'row count' AS problem UNION ALL SELECT NULL, 'facts per source' UNION ALL SELECT 'src_tibetan_museum_exhibit_7', 'repeated source' WHERE (SELECT count(*) FROM part WHERE p_partkey % 50 = 0) > 0
UNION ALL SELECT 'src_tibetan_museum_exhibit_7', 'exhibit id' FROM part WHERE p_partkey % 50 = 0""",
    "t14_inheritor_facts": f"""WITH c AS (SELECT *, 'project' || c_custkey AS project, 'src_' || c_custkey AS src, {_BARE.format("c_name")} AS person FROM customer WHERE {_GOOD_C}),
f AS (SELECT project AS subject, 'inherited_by' AS predicate, person AS object, src FROM c UNION ALL SELECT project, 'belongs_to_category', {_BARE.format("c_mktsegment")}, src FROM c UNION ALL SELECT project, 'declared_by', '省', src FROM c
  UNION ALL SELECT project, 'has_level', '国家级', src FROM c UNION ALL SELECT person, 'associated_with_ethnic_group', '族', src FROM c WHERE c_custkey % 2 = 0)
SELECT {_ID} AS fact_id, subject, predicate, object FROM f""",
    "t14_inheritor_issues": """SELECT source_id, array_to_string(r, ',') AS reasons FROM (SELECT 'src_' || c_custkey AS source_id, list_filter([CASE WHEN c_custkey % 7 = 0 THEN 'missing_applicant' END, CASE WHEN c_custkey % 11 = 0 THEN 'missing_document' END,
  CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 5 = 0 THEN 'page_missing_category' END, CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 13 = 0 THEN 'person_title_mismatch' END], lambda x: x IS NOT NULL) AS r FROM customer) WHERE len(r) > 0""",
    "t15_museum_facts": f"WITH {_MUSEUM} SELECT {_ID} AS fact_id, subject, predicate, object, evidence_text FROM rel",
    "t15_museum_issues": f"""WITH {_MUSEUM} SELECT source_id, array_to_string(r, ',') AS reasons FROM (SELECT 'src_' || p_partkey AS source_id, list_filter([CASE WHEN p_partkey % 9 = 0 THEN 'missing_registry_source' END, CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 10 = 0 THEN 'missing_raw_detail' END,
  CASE WHEN p_partkey % 9 <> 0 AND p_partkey % 10 <> 0 AND p_partkey % 19 = 0 THEN 'content_sha256_mismatch' END, CASE WHEN hashed AND p_partkey % 8 = 0 THEN 'category_mismatch' END, CASE WHEN hashed AND p_partkey % 6 = 0 THEN 'source_not_parsed' END,
  CASE WHEN hashed AND p_partkey % 17 = 0 THEN 'source_url_mismatch' END], lambda x: x IS NOT NULL) AS r FROM judged) WHERE len(r) > 0""",
    "up10_review_marks": f"WITH {_MUSEUM} SELECT {_ID} AS fact_id, p_partkey % 4 <> 0 AND p_partkey % 3 = 1 AS manual_checked, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 3 = 1 THEN 'manual_review_id=m1; reviewed_at=2024-05-06; source_content_sha256=' || sha256(CAST(p_partkey AS VARCHAR)) ELSE '' END AS notes FROM rel",
    "up10_review_cancelled": "SELECT 0 AS marked, 1 AS issues",
}
