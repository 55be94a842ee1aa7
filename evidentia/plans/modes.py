"""Registered queries for encoders, the vector index, retrieval by mode and its evaluation, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.operators import entities as E
from evidentia.operators import hybrid as H
from evidentia.operators import retrieval as R
from evidentia.plans import derived as D
from evidentia.plans import retrieval as RP
from evidentia.plans import views as V
from evidentia.plans.relational import ENTITIES
from evidentia.plans.shared import folder

LETTERS = "aeinorst"
ALL_MODES = ("vector-only", "bm25-only", "graph-only", "hybrid", "vector-only+rerank", "bm25-only+rerank", "graph-only+rerank", "hybrid+rerank")


def encode(text: Column) -> Column:
    """A deterministic stand-in for an encoder: how often each of LETTERS stands in the text, normalised."""
    # LETTERS have a byte each.
    counts = lambda low, n: F.array(*((n - F.octet_length(F.replace(low, F.lit(c), F.lit("")))).cast("double") for c in LETTERS))
    return R.l2_normalised(R.once(F.lower(F.coalesce(text, F.lit(""))), lambda low: R.once(F.octet_length(low), lambda n: counts(low, n))))


def score_pair(question: Column, text: Column) -> Column:
    """A deterministic stand-in for a pair model."""
    return R.query_overlap(question, text) * 100.0 / (100.0 + F.char_length(text))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("chk"), F.lpad(F.col("doc_id").cast("string"), 9, "0")).alias("chunk_id"), F.concat(F.lit("src_"), F.coalesce("source", F.lit("none"))).alias("source_id"), F.coalesce("text", F.lit("")).alias("text"), F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("source_url"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that also ask for the place of a supplier."""
    n = F.col("item_id")
    return V.table(spark, sf_dir, "benchmark").select(
        n.alias("qid"), F.concat(F.lit("where is Supplier#"), (n % 10 + 1).cast("string"), F.lit(" located? "), F.coalesce("text", F.lit(""))).alias("question"),
        F.array(F.concat(F.lit("src_src"), (n % 10 + 1).cast("string"))).alias("gold_sources"), F.array().cast("array<string>").alias("gold_facts"), (n % 9 == 0).alias("unanswerable"),
    )


def retriever(spark: SparkSession, sf_dir: str) -> H.Retriever:
    c = chunks(spark, sf_dir)
    f = D._facts(spark, sf_dir)
    graph = H.graph_leaf(E.build_entities(f), f, V.sources(spark, sf_dir), 1, D.CUES)
    return H.Retriever(H.vector_leaf(c, c.select("chunk_id", encode(F.col("text")).alias("embedding")), encode), H.bm25_leaf(c), graph, score_pair)


def encoder_seam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a batch model through the Arrow seam."""
    load = lambda: lambda texts: [[t.lower().count(c) for c in LETTERS] for t in texts]
    v = V.table(spark, sf_dir, "documents").select("doc_id", R.encoder(load, "letters")(F.col("text")).alias("v"))
    return v.select("doc_id", *(F.round(F.col("v")[i].cast("double"), 5).alias(f"v{i}") for i in range(len(LETTERS))))


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index is built, found again, follows chunks that go and texts that change, and is built anew for another model."""
    path, c = folder(spark, "vectors"), chunks(spark, sf_dir).select("chunk_id", "source_id", "text")
    left = c.filter("source_id <> 'src_src1'")
    changed = left.withColumn("text", F.when(F.substring("chunk_id", -1, 1) == "0", F.concat("text", F.lit(" once more"))).otherwise(F.col("text")))
    rows = []
    for name, part, model in (("build", c, "m1"), ("again", c, "m1"), ("some gone", left, "m1"), ("some changed", changed, "m1"), ("other model", changed, "m2")):
        manifest, reused = H.build_index(part.select("chunk_id", "text"), path, encode, model)
        rows.append((name, reused, manifest["count"], manifest["dimension"], manifest["encoded"], manifest["removed"]))
    return spark.createDataFrame(rows, "step string, reused boolean, n long, dimension int, encoded long, removed long")


def available_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The modes by which each question can be asked, if its number's bits tell which leaves and scorer there are."""
    leaf = lambda q, k: q
    modes = [H.Retriever(*(leaf if n >> bit & 1 else None for bit in range(3)), score_pair if n >> 3 & 1 else None).modes() for n in range(16)]
    known = F.array(*(F.array(*map(F.lit, m)).cast("array<string>") for m in modes))
    return V.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.explode(F.get(known, (F.col("item_id") % 16).cast("int"))).alias("mode"))


def _mode(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = retriever(spark, sf_dir).retrieve(questions(spark, sf_dir), mode, 5, 6)
        return found.select("qid", "evidence_id", "source_id", "kind", "score", "retrieval_score", "rank")

    return query


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.run_evaluation(questions(spark, sf_dir), retriever(spark, sf_dir), 5, minimum_score=0.05)


QUERIES = {"r5_encoder": encoder_seam, "r6_vector_index": vector_index, "r18_modes": available_modes, "r24_evaluation": evaluation}
QUERIES |= {f"r19_{m.replace('-only', '').replace('+', '_')}": _mode(m) for m in ALL_MODES}

_COUNTS = "list_transform(['a', 'e', 'i', 'n', 'o', 'r', 's', 't'], lambda c: CAST(length(lower({0})) - length(replace(lower({0}), c, '')) AS DOUBLE))"
_NORM = "CASE WHEN list_inner_product({0}, {0}) > 0 THEN list_transform({0}, lambda x: CAST(x / sqrt(list_inner_product({0}, {0})) AS FLOAT)) ELSE list_transform({0}, lambda x: CAST(x AS FLOAT)) END"
_VECTOR = lambda t: _NORM.format(f"({_COUNTS.format(t)})")
_OVERLAP = "len(list_intersect(list_distinct(list_filter(string_split(question, ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}_]'))), list_distinct(string_split(text, '')))) / greatest(len(list_distinct(list_filter(string_split(question, ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}_]')))), 1)".replace("{{", "{").replace("}}", "}")

#: All leaves' rows: vector_rows, bm25_rows and graph_rows (qid, question, evidence_id, source_id, text, bare, score, confidence, kind, rank).
LEAVES = rf"""{V.FACTS}, {V.SOURCES}, {ENTITIES},
chunks AS (SELECT 'chk' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS chunk_id, 'src_' || coalesce(source, 'none') AS source_id, coalesce(text, '') AS text FROM documents),
questions AS (SELECT item_id AS qid, 'where is Supplier#' || (item_id % 10 + 1) || ' located? ' || coalesce(text, '') AS question, 'src_src' || (item_id % 10 + 1) AS gold, item_id % 9 = 0 AS unanswerable FROM benchmark),
doc_tokens AS (SELECT chunk_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS words FROM chunks),
posts AS (SELECT chunk_id, term, count(*) AS tf, any_value(len) AS len FROM (SELECT chunk_id, len(words) AS len, unnest(words) AS term FROM doc_tokens) GROUP BY chunk_id, term),
stats AS (SELECT count(*) AS n, sum(len(words)) / greatest(count(*), 1) AS mean FROM doc_tokens),
terms AS (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posts, stats GROUP BY term),
asked AS (SELECT qid, term, count(*) AS qtf FROM (SELECT qid, unnest(regexp_extract_all(lower(question), '[\p{{L}}\p{{N}}_]+')) AS term FROM questions) GROUP BY qid, term),
bm25 AS (SELECT qid, chunk_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / greatest(mean, 1e-9)))), 6) AS score FROM asked JOIN posts USING (term) JOIN terms USING (term), stats GROUP BY qid, chunk_id),
vectors AS (SELECT chunk_id, {_VECTOR('text')} AS v FROM chunks),
queries AS (SELECT qid, {_VECTOR('question')} AS q FROM questions),
dense AS (SELECT qid, chunk_id, round(list_inner_product(CAST(v AS DOUBLE[]), CAST(q AS DOUBLE[])), 6) AS score FROM vectors, queries),
bm25_rows AS (SELECT qid, question, chunk_id AS evidence_id, source_id, text, score, CAST(NULL AS VARCHAR) AS confidence, 'bm25' AS kind, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, chunk_id) AS rank FROM bm25 WHERE score > 0) JOIN chunks USING (chunk_id) JOIN questions USING (qid) WHERE rank <= 5),
vector_rows AS (SELECT qid, question, chunk_id AS evidence_id, source_id, text, score, CAST(NULL AS VARCHAR) AS confidence, 'vector' AS kind, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, chunk_id) AS rank FROM dense) JOIN chunks USING (chunk_id) JOIN questions USING (qid) WHERE rank <= 5),
{D.MENTIONS}, {D.EDGES}, {D._reach(2)},
touched AS (SELECT u AS node, fact_id FROM edges UNION SELECT v, fact_id FROM edges),
near AS (SELECT qid, fact_id, min(distance) AS distance FROM touched JOIN r2 USING (node) GROUP BY 1, 2),
met AS (SELECT n.qid, n.fact_id, n.distance, f.predicate, f.evidence_source_id AS source_id, f.subject || ' — ' || f.predicate || ' — ' || f.object AS text, f.confidence, q.question FROM near n JOIN facts f USING (fact_id) JOIN questions q USING (qid)),
graded AS (SELECT *, round(least(1.0, 0.5 / (1 + distance) + 0.3 * CASE confidence WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.75 WHEN 'low' THEN 0.4 ELSE 0.5 END + 0.2 * {_OVERLAP}
    + CASE WHEN (predicate = 'located_in' AND (contains(question, 'located') OR contains(question, 'where'))) OR (predicate = 'belongs_to_category' AND (contains(question, 'category') OR contains(question, 'kind'))) THEN 0.2 ELSE 0 END), 6) AS score,
  CASE predicate WHEN 'located_in' THEN least(nullif(instr(question, 'located'), 0), nullif(instr(question, 'where'), 0)) * 1000 WHEN 'belongs_to_category' THEN least(nullif(instr(question, 'category'), 0), nullif(instr(question, 'kind'), 0)) * 1000 + 1 END AS cue FROM met),
held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, predicate ORDER BY score DESC, fact_id) AS r FROM graded WHERE cue IS NOT NULL) WHERE r = 1),
turned AS (SELECT s.*, coalesce(h.cue, 1099511627776) AS turn FROM graded s LEFT JOIN held h ON h.qid = s.qid AND h.fact_id = s.fact_id),
graph_all AS (SELECT qid, question, fact_id AS evidence_id, source_id, text, score, confidence, 'graph' AS kind, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY turn, score DESC, fact_id) AS rank FROM turned) WHERE rank <= 10),
normal_v AS (SELECT *, CASE WHEN max(score) OVER (PARTITION BY qid) <= 0 THEN 1.0 WHEN score > 0 THEN score / max(score) OVER (PARTITION BY qid) END AS part FROM vector_rows),
normal_b AS (SELECT *, CASE WHEN max(score) OVER (PARTITION BY qid) <= 0 THEN 1.0 WHEN score > 0 THEN score / max(score) OVER (PARTITION BY qid) END AS part FROM bm25_rows),
fused AS (SELECT coalesce(a.qid, b.qid) AS qid, coalesce(a.question, b.question) AS question, coalesce(a.evidence_id, b.evidence_id) AS evidence_id, coalesce(a.source_id, b.source_id) AS source_id, coalesce(a.text, b.text) AS text, round(0.6 * coalesce(a.part, 0) + 0.4 * coalesce(b.part, 0), 6) AS score,
  CAST(NULL AS VARCHAR) AS confidence, CASE WHEN a.part IS NOT NULL AND b.part IS NOT NULL THEN 'vector+bm25' WHEN a.qid IS NOT NULL THEN 'vector' ELSE 'bm25' END AS kind FROM normal_v a FULL JOIN normal_b b ON a.qid = b.qid AND a.evidence_id = b.evidence_id),
pool AS (SELECT qid, question, evidence_id, source_id, text, score, confidence, kind, CAST(NULL AS DOUBLE) AS retrieval_score FROM fused UNION ALL SELECT qid, question, evidence_id, source_id, text, score, confidence, kind, NULL FROM graph_all),
pool_again AS (SELECT qid, question, evidence_id, source_id, text, round({_OVERLAP} * 100.0 / (100.0 + length(text)), 6) AS score, confidence, kind, score AS retrieval_score FROM pool)"""


def _again(rows: str, budget: int) -> str:
    return f"""SELECT qid, evidence_id, source_id, text, kind, score, retrieval_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, evidence_id) AS rank
  FROM (SELECT qid, evidence_id, source_id, text, kind, round({_OVERLAP} * 100.0 / (100.0 + length(text)), 6) AS score, score AS retrieval_score FROM {rows})) WHERE rank <= {budget}"""


def _allocated(pool: str, budget: int) -> str:
    return f"""(WITH worth AS (SELECT *, round(score + 0.2 * {_OVERLAP} + CASE confidence WHEN 'high' THEN 0.15 WHEN 'medium' THEN 0.08 ELSE 0 END, 6) AS worth FROM {pool}),
  turns AS (SELECT *, row_number() OVER (PARTITION BY qid, source_id ORDER BY worth DESC, evidence_id) AS turn FROM worth),
  taken AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY turn, worth DESC, evidence_id) AS rank FROM turns) WHERE rank <= {budget}),
  marks AS (SELECT qid, bool_or(kind = 'graph') AS has_graph, max(rank) AS last FROM taken GROUP BY qid),
  swap AS (SELECT g.* EXCLUDE (k), m.last AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY coalesce(retrieval_score, worth) DESC, worth DESC, evidence_id) AS k FROM worth WHERE kind = 'graph') g JOIN marks m USING (qid) WHERE k = 1 AND NOT has_graph)
  SELECT qid, evidence_id, source_id, text, kind, score, retrieval_score, rank FROM taken t WHERE NOT EXISTS (SELECT 1 FROM swap s WHERE s.qid = t.qid AND s.rank = t.rank) UNION ALL SELECT qid, evidence_id, source_id, text, kind, score, retrieval_score, rank FROM swap)"""


def _mode_sql(mode: str, budget: int) -> str:
    base, _, again = mode.partition("+")
    if base == "hybrid":
        return f"SELECT * FROM {_allocated('pool_again' if again else 'pool', budget)}"
    rows = {"vector-only": "vector_rows", "bm25-only": "bm25_rows", "graph-only": f"(SELECT * FROM graph_all WHERE rank <= {budget})"}[base]
    return _again(rows, budget) if again else f"SELECT qid, evidence_id, source_id, text, kind, score, CAST(NULL AS DOUBLE) AS retrieval_score, rank FROM {rows}"


def _metrics_sql(mode: str) -> str:
    return f"""SELECT '{mode}' AS mode, count(*) AS n_questions, round(avg(CAST(first IS NOT NULL AS INT)) FILTER (NOT unanswerable), 6) AS recall_at_k, round(avg(coalesce(1.0 / first, 0)) FILTER (NOT unanswerable), 6) AS mrr, round(avg(CAST(first IS NOT NULL AS INT)) FILTER (NOT unanswerable), 6) AS hit_rate,
  round(avg(coalesce(diversity, 0)), 6) AS source_diversity, round(avg(CAST(coalesce(n, 0) = 0 AS INT)) FILTER (unanswerable), 6) AS refusal_rate, 1.0 AS citation_rate
FROM questions q LEFT JOIN (SELECT qid, min(CASE WHEN source_id = gold THEN rank END) AS first, count(DISTINCT source_id) AS diversity, count_if(score >= 0.05) AS n FROM ({_mode_sql(mode, 5)}) JOIN questions USING (qid) GROUP BY qid) p USING (qid)"""


ORACLE_SQL = {
    "r5_encoder": f"SELECT doc_id, {', '.join(f'round(CAST(v[{i + 1}] AS DOUBLE), 5) AS v{i}' for i in range(8))} FROM (SELECT doc_id, {_VECTOR('coalesce(text, chr(32))')} AS v FROM documents)",
    "r6_vector_index": """WITH c AS (SELECT coalesce(source, 'none') = 'src1' AS gone, doc_id % 10 = 0 AS changed FROM documents), n AS (SELECT count(*) AS every, count_if(gone) AS gone, count_if(NOT gone) AS left_, count_if(NOT gone AND changed) AS changed FROM c)
SELECT 'build' AS step, false AS reused, every AS n, 8 AS dimension, every AS encoded, 0 AS removed FROM n UNION ALL SELECT 'again', true, every, 8, 0, 0 FROM n UNION ALL SELECT 'some gone', false, left_, 8, 0, gone FROM n
UNION ALL SELECT 'some changed', false, left_, 8, changed, 0 FROM n UNION ALL SELECT 'other model', false, left_, 8, left_, 0 FROM n""",
    "r18_modes": """WITH q AS (SELECT item_id AS qid, item_id & 1 > 0 AS v, item_id & 2 > 0 AS b, item_id & 4 > 0 AS g, item_id & 8 > 0 AS s FROM benchmark),
base AS (SELECT qid, s, 'vector-only' AS mode FROM q WHERE v UNION ALL SELECT qid, s, 'bm25-only' FROM q WHERE b UNION ALL SELECT qid, s, 'graph-only' FROM q WHERE g
  UNION ALL SELECT qid, s, 'hybrid' FROM q WHERE CAST(v AS INT) + CAST(b AS INT) + CAST(g AS INT) >= 2)
SELECT qid, mode FROM base UNION ALL SELECT qid, mode || '+rerank' FROM base WHERE s""",
    "r24_evaluation": f"WITH {LEAVES} " + " UNION ALL ".join(map(_metrics_sql, ALL_MODES)),
}
ORACLE_SQL |= {f"r19_{m.replace('-only', '').replace('+', '_')}": f"WITH {LEAVES} SELECT qid, evidence_id, source_id, kind, score, retrieval_score, rank FROM ({_mode_sql(m, 6)})" for m in ALL_MODES}
