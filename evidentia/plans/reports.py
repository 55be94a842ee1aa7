"""The dataset report as a registered query, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import entities as E
from evidentia.operators.report import dataset_report
from evidentia.plans import views as V
from evidentia.plans.derived import _facts
from evidentia.plans.relational import ENTITIES, _chunks

RESTRICTED = ["s4.example.org"]


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = V.sources(spark, sf_dir).withColumns({"source_type": F.concat(F.lit("type "), F.substring("publisher", -1, 1)), "domain": F.regexp_extract("url", "//www[.]([^/]*)/", 1)})
    n = F.col("item_id")
    source = lambda k: F.concat(F.lit("src_src"), k.cast("string"))
    questions = V.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("kind "), (n % 3).cast("string")).alias("answer_type"), (n % 9 == 0).alias("unanswerable"), (n % 4 == 0).alias("manual_checked"),
        F.array(source(n % 20), source(n % 7), F.lit("src_nowhere")).alias("evidence_source_ids"),
    )
    facts = _facts(spark, sf_dir)
    return dataset_report(sources, E.build_entities(facts), facts, _chunks(spark, sf_dir), questions, RESTRICTED)


QUERIES = {"ag1_report": report}

ORACLE_SQL = {
    "ag1_report": f"""WITH {V.FACTS}, {V.SOURCES}, {ENTITIES},
s AS (SELECT *, 'type ' || right(publisher, 1) AS source_type, regexp_extract(url, '//www[.]([^/]*)/', 1) AS domain FROM sources),
c AS (SELECT 'src_' || source AS source_id, length(coalesce(text, '')) AS len, CASE WHEN doc_id % 5 < 2 THEN 'open_text' ELSE 'synthetic_fact' END AS kind FROM documents WHERE source IS NOT NULL),
q AS (SELECT 'kind ' || (item_id % 3) AS answer_type, item_id % 9 = 0 AS unanswerable, item_id % 4 = 0 AS manual, list_distinct(['src_src' || (item_id % 20), 'src_src' || (item_id % 7), 'src_nowhere']) AS ids FROM benchmark),
links AS (SELECT unnest(ids) AS source_id FROM q),
closed AS (SELECT source_id FROM s WHERE license_status IN ('restricted', 'forbidden') OR release_policy IN ('local_only', 'exclude', 'metadata_and_facts_only') OR domain = 's4.example.org' OR domain LIKE '%.s4.example.org'),
barred AS (SELECT c.* FROM c JOIN closed USING (source_id)),
n AS (SELECT (SELECT count(*) FROM s) AS s, (SELECT count(*) FROM entities) AS e, (SELECT count(*) FROM facts) AS f, (SELECT count(*) FROM c) AS c, (SELECT count(*) FROM q) AS q),
found AS (
  SELECT 'source_type' AS section, source_type AS key, count(*) AS value FROM s GROUP BY 2 UNION ALL SELECT 'release_policy', release_policy, count(*) FROM s GROUP BY 2
  UNION ALL SELECT 'topic', t, count(*) FROM (SELECT unnest(topic) AS t FROM s) GROUP BY 2 UNION ALL SELECT 'region', t, count(*) FROM (SELECT unnest(region) AS t FROM s) GROUP BY 2
  UNION ALL SELECT 'entity_type', type, count(*) FROM entities GROUP BY 2 UNION ALL SELECT 'relation', predicate, count(*) FROM facts GROUP BY 2
  UNION ALL SELECT 'chunk_kind', kind, count(*) FROM c GROUP BY 2 UNION ALL SELECT 'answer_type', answer_type, count(*) FROM q GROUP BY 2
  UNION ALL SELECT 'counts', 'sources', s FROM n UNION ALL SELECT 'counts', 'entities', e FROM n UNION ALL SELECT 'counts', 'facts', f FROM n UNION ALL SELECT 'counts', 'chunks', c FROM n UNION ALL SELECT 'counts', 'qa', q FROM n
  UNION ALL SELECT 'counts', 'manually_checked_facts', count_if(manual_checked) FROM facts UNION ALL SELECT 'counts', 'manually_checked_qa', count_if(manual) FROM q
  UNION ALL SELECT 'facts', 'verified', count_if(verified) FROM facts UNION ALL SELECT 'qa', 'unanswerable_count', count_if(unanswerable) FROM q
  UNION ALL SELECT 'restricted_audit', 'sources', count(*) FROM closed UNION ALL SELECT 'restricted_audit', 'all_chunk_records', count(*) FROM barred
  UNION ALL SELECT 'restricted_audit', 'synthetic_fact_chunks', count_if(kind = 'synthetic_fact') FROM barred UNION ALL SELECT 'restricted_audit', 'open_text_violations', count_if(kind = 'open_text') FROM barred
  UNION ALL SELECT 'restricted_audit', 'passed', CAST(count_if(kind = 'open_text') = 0 AS INT) FROM barred
  UNION ALL SELECT 'source_facts', source_id, (SELECT count(*) FROM facts WHERE evidence_source_id = s.source_id) FROM s UNION ALL SELECT 'source_chunks', source_id, (SELECT count(*) FROM c WHERE c.source_id = s.source_id) FROM s
  UNION ALL SELECT 'source_qa', source_id, (SELECT count(*) FROM links WHERE links.source_id = s.source_id) FROM s)
SELECT section, key, CAST(value AS DOUBLE) AS value FROM found
UNION ALL SELECT 'chunks', 'average_length_chars', round(avg(len), 6) FROM c UNION ALL SELECT 'chunks', 'median_length_chars', CAST(median(len) AS DOUBLE) FROM c
UNION ALL SELECT 'qa', 'unanswerable_ratio', round(count_if(unanswerable) / count(*), 6) FROM q
UNION ALL SELECT 'average_per_source', 'facts', round(f / s, 6) FROM n UNION ALL SELECT 'average_per_source', 'chunks', round(c / s, 6) FROM n UNION ALL SELECT 'average_per_source', 'qa', round((SELECT count(*) FROM links) / s, 6) FROM n""",
}
