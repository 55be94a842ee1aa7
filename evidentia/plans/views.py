"""The model's relations as views of the driver tables, each as a DataFrame and as the SQL of a CTE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import ids


#: Tables whose rows are texts: what is done with a row costs far more than to move it.
TEXTS = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Texts in fewer files than there are cores are dealt to all cores first."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in TEXTS and len(df._jdf.inputFiles()) < cores else df


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registered source for each document source; policies and states follow from its number."""
    n = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    found = table(spark, sf_dir, "documents").select("source").distinct().filter("source is not null").withColumn("n", n)
    return found.select(
        F.concat(F.lit("src_"), "source").alias("source_id"),
        F.concat(F.lit("Source "), F.col("n").cast("string")).alias("title"),
        F.concat(F.lit("publisher "), (F.col("n") % 6).cast("string")).alias("publisher"),
        F.concat(F.lit("https://www.s"), (F.col("n") % 9).cast("string"), F.lit(".example.org/"), "source", F.lit("/")).alias("url"),
        F.element_at(F.array(*map(F.lit, ("open", "government_public", "unclear", "restricted"))), F.col("n") % 4 + 1).alias("license_status"),
        F.element_at(F.array(*map(F.lit, ("full_text_allowed", "government_public", "metadata_and_facts_only", "local_only"))), F.col("n") % 4 + 1).alias("release_policy"),
        (F.col("n") % 4 < 2).alias("raw_text_release"),
        F.when(F.col("n") % 7 == 6, "failed").when(F.col("n") % 7 == 5, "pending").otherwise("parsed").alias("crawl_status"),
        F.array(F.concat(F.lit("topic "), (F.col("n") % 3).cast("string"))).alias("topic"),
        F.array(F.concat(F.lit("region "), (F.col("n") % 5).cast("string"))).alias("region"),
        F.lit("").alias("notes"),
    )


SOURCES = r"""
sources AS (
  SELECT 'src_' || source AS source_id, 'Source ' || n AS title, 'publisher ' || (n % 6) AS publisher,
         'https://www.s' || (n % 9) || '.example.org/' || source || '/' AS url,
         (['open', 'government_public', 'unclear', 'restricted'])[n % 4 + 1] AS license_status,
         (['full_text_allowed', 'government_public', 'metadata_and_facts_only', 'local_only'])[n % 4 + 1] AS release_policy,
         n % 4 < 2 AS raw_text_release,
         CASE WHEN n % 7 = 6 THEN 'failed' WHEN n % 7 = 5 THEN 'pending' ELSE 'parsed' END AS crawl_status,
         ['topic ' || (n % 3)] AS topic, ['region ' || (n % 5)] AS region, '' AS notes
  FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '(\d+)', 1) AS INT) AS n FROM documents WHERE source IS NOT NULL)
)"""

_TRIPLE = "subject string, subject_type string, predicate string, object string, object_type string, evidence_source_id string, n long"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples of the star schema, each with its identity, confidence and review flags."""
    part, supplier, customer = (table(spark, sf_dir, t) for t in ("part", "supplier", "customer"))
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")

    def triples(df, subject, kind, predicate, obj, obj_kind, source, n):
        return df.select(subject.alias("subject"), F.lit(kind).alias("subject_type"), F.lit(predicate).alias("predicate"), obj.alias("object"), F.lit(obj_kind).alias("object_type"), source.alias("evidence_source_id"), n.cast("long").alias("n"))

    name = lambda label, key: F.concat(F.lit(label), F.col(key).cast("string"))
    source = lambda key: F.concat(F.lit("src_src"), (F.col(key) % 20).cast("string"))
    of_nation = nation.select(F.col("n_nationkey"), "n_name", "n_regionkey")
    out = triples(part, name("Part#", "p_partkey"), "MUSEUM_OBJECT", "belongs_to_category", F.col("p_type"), "CATEGORY", source("p_partkey"), F.col("p_partkey"))
    out = out.union(triples(part, name("Part#", "p_partkey"), "MUSEUM_OBJECT", "made_of", F.col("p_brand"), "MATERIAL", source("p_partkey"), F.col("p_partkey")))
    s = supplier.join(F.broadcast(of_nation), F.col("s_nationkey") == F.col("n_nationkey"))
    out = out.union(triples(s, name("Supplier#", "s_suppkey"), "ICH_PROJECT", "located_in", F.col("n_name"), "REGION", source("s_suppkey"), F.col("s_suppkey")))
    c = customer.join(F.broadcast(of_nation), F.col("c_nationkey") == F.col("n_nationkey"))
    out = out.union(triples(c, name("Customer#", "c_custkey"), "PERSON", "located_in", F.col("n_name"), "REGION", source("c_custkey"), F.col("c_custkey")))
    out = out.union(triples(customer, name("Customer#", "c_custkey"), "PERSON", "belongs_to_category", F.col("c_mktsegment"), "CATEGORY", source("c_custkey"), F.col("c_custkey")))
    r = of_nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    out = out.union(triples(r, F.col("n_name"), "REGION", "located_in", F.col("r_name"), "REGION", source("n_nationkey"), F.col("n_nationkey")))
    return out.select(
        ids.fact_id(*(F.col(c) for c in ("subject", "predicate", "object", "evidence_source_id"))).alias("fact_id"), "subject", "subject_type", "predicate", "object", "object_type", "evidence_source_id",
        F.concat(F.lit("https://example.org/"), "evidence_source_id").alias("evidence_url"),
        F.concat("subject", F.lit(" / "), "predicate", F.lit("："), "object").alias("evidence_text"),
        (F.col("n") % 11 != 0).alias("verified"),
        F.when(F.col("n") % 5 == 0, "high").when(F.col("n") % 13 == 0, "low").otherwise("medium").alias("confidence"),
        (F.col("n") % 17 == 0).alias("manual_checked"), F.lit("").alias("notes"), "n",
    )


FACTS = r"""
triples AS (
  SELECT 'Part#' || p_partkey AS subject, 'MUSEUM_OBJECT' AS subject_type, 'belongs_to_category' AS predicate, p_type AS object, 'CATEGORY' AS object_type, 'src_src' || (p_partkey % 20) AS evidence_source_id, p_partkey AS n FROM part
  UNION ALL SELECT 'Part#' || p_partkey, 'MUSEUM_OBJECT', 'made_of', p_brand, 'MATERIAL', 'src_src' || (p_partkey % 20), p_partkey FROM part
  UNION ALL SELECT 'Supplier#' || s_suppkey, 'ICH_PROJECT', 'located_in', n_name, 'REGION', 'src_src' || (s_suppkey % 20), s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'Customer#' || c_custkey, 'PERSON', 'located_in', n_name, 'REGION', 'src_src' || (c_custkey % 20), c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'Customer#' || c_custkey, 'PERSON', 'belongs_to_category', c_mktsegment, 'CATEGORY', 'src_src' || (c_custkey % 20), c_custkey FROM customer
  UNION ALL SELECT n_name, 'REGION', 'located_in', r_name, 'REGION', 'src_src' || (n_nationkey % 20), n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey
),
facts AS (
  SELECT 'fact_' || substr(sha256(subject || chr(0) || predicate || chr(0) || object || chr(0) || evidence_source_id), 1, 12) AS fact_id,
         subject, subject_type, predicate, object, object_type, evidence_source_id,
         'https://example.org/' || evidence_source_id AS evidence_url, subject || ' / ' || predicate || '：' || object AS evidence_text,
         n % 11 <> 0 AS verified, CASE WHEN n % 5 = 0 THEN 'high' WHEN n % 13 = 0 THEN 'low' ELSE 'medium' END AS confidence,
         n % 17 = 0 AS manual_checked, '' AS notes, n
  FROM triples
)"""
