"""Registered retrieval queries over the driver tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import retrieval as R
from evidentia.operators.index import Index
from evidentia.plans.shared import folder
from evidentia.plans.views import table

# Documents are the chunks, benchmark items the questions.
TOKENS = r"""
doc_tokens AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS words FROM documents),
posts AS (SELECT doc_id, term, count(*) AS tf, any_value(len) AS len FROM (SELECT doc_id, len(words) AS len, unnest(words) AS term FROM doc_tokens) GROUP BY doc_id, term),
stats AS (SELECT count(*) AS n, sum(len(words)) / greatest(count(*), 1) AS mean FROM doc_tokens),
terms AS (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM posts, stats GROUP BY term),
asked AS (SELECT item_id AS qid, term, count(*) AS qtf FROM (SELECT item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')) AS term FROM benchmark) GROUP BY item_id, term),
bm25 AS (
  SELECT qid, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / greatest(mean, 1e-9)))), 6) AS score
  FROM asked JOIN posts USING (term) JOIN terms USING (term), stats GROUP BY qid, doc_id
)"""
TOP = """bm25_top AS (
  SELECT * FROM (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM bm25 WHERE score > 0) WHERE rank <= 10
)"""
# A second scorer for fusion: shared distinct terms over the question's distinct terms.
COVER = """cover AS (
  SELECT qid, doc_id, round(count(*) / any_value(own), 6) AS score
  FROM asked JOIN posts USING (term) JOIN (SELECT qid, count(*) AS own FROM asked GROUP BY qid) USING (qid) GROUP BY qid, doc_id
),
cover_top AS (
  SELECT * FROM (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM cover) WHERE rank <= 10
)"""
FUSED = """fused AS (
  SELECT coalesce(a.qid, b.qid) AS qid, coalesce(a.doc_id, b.doc_id) AS id,
         round(0.6 * coalesce(a.score / a.top, 0) + 0.4 * coalesce(b.score / b.top, 0), 6) AS score,
         CASE WHEN a.qid IS NOT NULL AND b.qid IS NOT NULL THEN 'vector+bm25' WHEN a.qid IS NOT NULL THEN 'vector' ELSE 'bm25' END AS kind
  FROM (SELECT *, max(score) OVER (PARTITION BY qid) AS top FROM cover_top) a
  FULL JOIN (SELECT *, max(score) OVER (PARTITION BY qid) AS top FROM bm25_top) b ON a.qid = b.qid AND a.doc_id = b.doc_id
)"""
EVIDENCE = r"""
evidence AS (
  SELECT f.qid, q.text AS question, f.id, d.source AS source_id, f.score, d.text, CASE WHEN f.id % 3 = 0 THEN 'high' WHEN f.id % 3 = 1 THEN 'medium' ELSE 'low' END AS confidence,
         CASE WHEN f.id % 4 = 0 THEN 'graph' ELSE f.kind END AS kind, CAST(NULL AS DOUBLE) AS retrieval_score
  FROM fused f JOIN documents d ON d.doc_id = f.id JOIN benchmark q ON q.item_id = f.qid
)"""


# The attribute rules: a question with all terms needs evidence with all terms of one option.
GATE = """wanted AS (SELECT ['游客数量', '客流量', '门票', '票价', '营业收入', '开放时间', '实时天气', '保护评估得分', '专项保护资金', '保护评估日期', '保护规划文号', '出土地点', '入藏日期', '文物定级', '修复日期', '国家级奖项', '正式弟子', '公开传习活动', '代表作品目录', '官方更新日期', '年度统计数据', '正式审查结论', '档案编号', '在哪里'] AS asked),
rules(a, b, options) AS (VALUES ('游客数量', '', [['游客数量', ''], ['客流量', '']]), ('客流量', '', [['游客数量', ''], ['客流量', '']]), ('门票', '', [['门票', ''], ['票价', '']]), ('票价', '', [['门票', ''], ['票价', '']]),
  ('营业收入', '', [['营业收入', '']]), ('开放时间', '', [['开放时间', '']]), ('实时天气', '', [['实时天气', '']]), ('保护评估', '得分', [['保护评估', '得分']]), ('专项保护资金', '', [['专项保护资金', '']]), ('保护评估', '日期', [['保护评估', '日期']]),
  ('保护规划文号', '', [['保护规划文号', '']]), ('出土地点', '', [['出土地点', '']]), ('入藏日期', '', [['入藏日期', '']]), ('文物定级', '', [['文物定级', '']]), ('修复', '日期', [['修复', '日期']]), ('国家级奖项', '', [['国家级奖项', '']]), ('正式弟子', '', [['正式弟子', '']]),
  ('公开传习活动', '', [['公开传习活动', '']]), ('代表作品目录', '', [['代表作品目录', '']]), ('官方更新', '日期', [['官方更新', '日期']]), ('年度统计数据', '', [['年度统计数据', '']]), ('正式审查', '结论', [['正式审查', '结论']]), ('档案编号', '', [['档案编号', '']]))"""
LACKING = """lacking AS (SELECT DISTINCT q.qid FROM questions q, rules r WHERE contains(q.question, r.a) AND contains(q.question, r.b)
  AND NOT EXISTS (SELECT 1 FROM top t WHERE t.qid = q.qid AND len(list_filter(r.options, lambda o: contains(t.text, o[1]) AND contains(t.text, o[2]))) > 0))"""


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))


_INDEXES: dict[tuple[str, str], Index] = {}


def _index(spark: SparkSession, sf_dir: str) -> Index:
    """The stored index of ``documents``: the first query of a session that asks for it builds it, later ones read it."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _INDEXES:
        _INDEXES[key] = Index(spark, folder(spark, "index")).add(table(spark, sf_dir, "documents"))
    return _INDEXES[key]


def _bm25(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    return _index(spark, sf_dir).bm25(_questions(spark, sf_dir), k)


def grown_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that grew by five additions, merged on the way, answers as one that was built at once."""
    docs, index = table(spark, sf_dir, "documents"), Index(spark, folder(spark, "index"))
    for k in range(5):
        index.add(docs.filter(F.col("doc_id") % 5 == k))
    index.vacuum()
    return index.bm25(_questions(spark, sf_dir), 5).select("qid", F.col("doc").alias("doc_id"), "score", "rank")


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bm25(spark, sf_dir, 5).select("qid", F.col("doc").alias("doc_id"), "score", "rank")


def bm25_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    posts = R.postings(docs, "doc_id", "text")
    n = docs.count()
    return R.term_statistics(posts, n).select("term", "df", F.round("idf", 6).alias("idf"))


def dense_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("query"))
    return R.dense(vectors, queries, 5).select("qid", F.col("id").alias("vec_id"), "score", "rank")


def _cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions = _questions(spark, sf_dir).select("qid", F.explode(F.array_distinct(T.tokens(F.col("question")))).alias("term"))
    own = questions.groupBy("qid").agg(F.count("*").alias("own"))
    questions = R.counted(questions)
    index = _index(spark, sf_dir)
    posts = index.asked("postings", questions.select("term").distinct())
    posts = R.by_document(posts, sum(s.n_docs for s in index.segments()), questions.select("qid").distinct().count())
    scored = posts.join(questions, "term").groupBy("qid", "doc").agg(F.count("*").alias("n")).join(R.counted(own), "qid")
    scored = scored.select("qid", F.col("doc").alias("id"), F.round(F.col("n") / F.col("own"), 6).alias("score"))
    return R.ranked(scored, 10, ["qid"], F.desc("score"), F.asc("id"))


def score_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.fuse(_cover(spark, sf_dir), _bm25(spark, sf_dir).withColumnRenamed("doc", "id")).select("qid", "id", "score", "kind")


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("source_id"), "text")
    fused = R.counted(score_fusion(spark, sf_dir)).join(_questions(spark, sf_dir), "qid").join(docs, "id")
    return fused.select(
        "qid", "question", "id", "source_id", "score", "text",
        F.when(F.col("id") % 3 == 0, "high").when(F.col("id") % 3 == 1, "medium").otherwise("low").alias("confidence"),
        F.when(F.col("id") % 4 == 0, "graph").otherwise(F.col("kind")).alias("kind"), F.lit(None).cast("double").alias("retrieval_score"),
    )


def evidence_allocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.allocate(_evidence(spark, sf_dir), 6).select("qid", "id", "source_id", "allocation_score", "place", "kind")


def rerank_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.rerank(_evidence(spark, sf_dir), lambda q, t: 1000.0 / (1000.0 + F.char_length(t)), 5)
    return out.select("qid", "id", "score", "retrieval_score", "rank")


#: What questions ask for in turn, by the support rules, and what the evidence of some documents says.
ASKED = ("游客数量", "客流量", "门票", "票价", "营业收入", "开放时间", "实时天气", "保护评估得分", "专项保护资金", "保护评估日期", "保护规划文号", "出土地点", "入藏日期", "文物定级", "修复日期", "国家级奖项", "正式弟子", "公开传习活动", "代表作品目录", "官方更新日期", "年度统计数据", "正式审查结论", "档案编号", "在哪里")


def _told(key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ASKED)), (key % len(ASKED) + 1).cast("int"))


def answer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question asks for one of ASKED; the documents found say one of them each, which answers it or not."""
    evidence = R.ranked(_evidence(spark, sf_dir), 4, ["qid"], F.desc("score"), F.asc("id"))
    evidence = evidence.withColumns({"source_url": F.lit(""), "text": F.concat("text", F.when(F.col("id") % 2 == 0, _told(F.col("qid") + F.col("id") % 3)).otherwise(_told(F.col("id"))))})
    questions = _questions(spark, sf_dir).withColumn("question", F.concat("question", _told(F.col("qid"))))
    return R.answer(questions, evidence, 0.6).select("qid", "refused", "n_evidence", F.sha2("answer", 256).alias("answer_sha"))


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with gold sources and facts; some are unanswerable."""
    n = F.col("item_id")
    src = lambda k: F.concat(F.lit("src"), (k % 20).cast("string"))
    return table(spark, sf_dir, "benchmark").select(n.alias("qid"), F.concat("text", _told(n)).alias("question"), F.array(src(n), src(n + 7)).alias("gold_sources"), F.array(F.concat(F.lit("doc"), (n * 3).cast("string"))).alias("gold_facts"), (n % 9 == 0).alias("unanswerable"))


def eval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.coalesce("source", F.lit("")).alias("source_id"), F.concat("text", _told(F.col("doc_id"))).alias("text"), F.when(F.col("doc_id") % 50 != 0, "https://example.org/").alias("source_url"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("fact_id"))
    return R.evaluate(R.counted(_bm25(spark, sf_dir, 5)).join(d, "doc"), _benchmark(spark, sf_dir), 5, 20.0)


QUERIES = {
    "tk2_sparse_topk": bm25_topk,
    "r2_index": grown_index,
    "ag20_bm25_corpus_stats": bm25_corpus_stats,
    "tk1_dense_topk": dense_topk,
    "r15_score_fusion": score_fusion,
    "r16_evidence_allocation": evidence_allocation,
    "r17_rerank_lexical": rerank_lexical,
    "r21_answer_gate": answer_gate,
    "r23_eval_metrics": eval_metrics,
}

ORACLE_SQL = {
    "tk2_sparse_topk": f"WITH {TOKENS}, {TOP} SELECT qid, doc_id, score, rank FROM bm25_top WHERE rank <= 5",
    "r2_index": f"WITH {TOKENS}, {TOP} SELECT qid, doc_id, score, rank FROM bm25_top WHERE rank <= 5",
    "ag20_bm25_corpus_stats": f"WITH {TOKENS} SELECT term, df, round(idf, 6) AS idf FROM terms",
    "tk1_dense_topk": """
SELECT * FROM (
  SELECT qid, vec_id, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rank
  FROM (SELECT q.vec_id AS qid, v.vec_id, round(list_inner_product(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score
        FROM embeddings v, embeddings q)
) WHERE rank <= 5""",
    "r15_score_fusion": f"WITH {TOKENS}, {TOP}, {COVER}, {FUSED} SELECT qid, id, score, kind FROM fused",
    "r16_evidence_allocation": f"""WITH {TOKENS}, {TOP}, {COVER}, {FUSED}, {EVIDENCE},
scored AS (
  SELECT *, round(score + 0.2 * len(list_intersect(own, list_distinct(string_split(text, '')))) / greatest(len(own), 1)
                  + CASE confidence WHEN 'high' THEN 0.15 WHEN 'medium' THEN 0.08 ELSE 0 END, 6) AS allocation_score
  FROM (SELECT *, list_distinct(list_filter(string_split(question, ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}_]'))) AS own FROM evidence)
),
turns AS (SELECT *, row_number() OVER (PARTITION BY qid, source_id ORDER BY allocation_score DESC, id) AS turn FROM scored),
taken AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY turn, allocation_score DESC, id) AS place FROM turns) WHERE place <= 6),
marks AS (SELECT qid, bool_or(kind LIKE 'graph%') AS has_graph, max(place) AS last FROM taken GROUP BY qid),
swap AS (
  SELECT g.qid, g.id, g.source_id, g.allocation_score, m.last AS place, g.kind
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY allocation_score DESC, id) AS r FROM scored WHERE kind LIKE 'graph%') g JOIN marks m USING (qid)
  WHERE g.r = 1 AND NOT m.has_graph
)
SELECT qid, id, source_id, allocation_score, place, kind FROM taken t WHERE NOT EXISTS (SELECT 1 FROM swap s WHERE s.qid = t.qid AND s.place = t.place)
UNION ALL SELECT * FROM swap""",
    "r17_rerank_lexical": f"""WITH {TOKENS}, {TOP}, {COVER}, {FUSED}, {EVIDENCE}
SELECT * FROM (
  SELECT qid, id, score, retrieval_score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank
  FROM (SELECT qid, id, round(1000.0 / (1000.0 + length(text)), 6) AS score, score AS retrieval_score FROM evidence)
) WHERE rank <= 5""",
    "r21_answer_gate": f"""WITH {TOKENS}, {TOP}, {COVER}, {FUSED}, {EVIDENCE}, {GATE},
top AS (SELECT e.qid, e.source_id, e.rank, e.text || CASE WHEN e.id % 2 = 0 THEN asked[(e.qid + e.id % 3) % 24 + 1] ELSE asked[e.id % 24 + 1] END AS text
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank FROM evidence) e, wanted WHERE rank <= 4 AND score >= 0.6),
questions AS (SELECT item_id AS qid, text || asked[item_id % 24 + 1] AS question FROM benchmark, wanted),
found AS (SELECT qid, count(*) AS n, string_agg('- ' || text || ' [' || source_id || ']()', chr(10) ORDER BY rank) AS cited FROM top GROUP BY qid),
{LACKING},
gate AS (SELECT q.qid, n, cited, n IS NULL OR l.qid IS NOT NULL AS refused FROM questions q LEFT JOIN found USING (qid) LEFT JOIN lacking l ON l.qid = q.qid)
SELECT qid, refused, CASE WHEN refused THEN 0 ELSE n END AS n_evidence,
       sha256(CASE WHEN refused THEN '当前数据集中没有足够依据回答。' ELSE '当前数据集中检索到以下可溯源证据：' || chr(10) || cited END) AS answer_sha
FROM gate""",
    "r23_eval_metrics": f"""WITH {TOKENS}, {TOP}, {GATE},
questions AS (SELECT item_id AS qid, text || asked[item_id % 24 + 1] AS question, ['src' || (item_id % 20), 'src' || ((item_id + 7) % 20)] AS gold, 'doc' || (item_id * 3) AS gold_fact, item_id % 9 = 0 AS unanswerable FROM benchmark, wanted),
every AS (SELECT t.qid, t.rank, t.score, coalesce(d.source, '') AS source_id, d.text || asked[d.doc_id % 24 + 1] AS text, d.doc_id % 50 = 0 AS bare, 'doc' || d.doc_id AS fact_id FROM bm25_top t JOIN documents d USING (doc_id), wanted WHERE t.rank <= 5),
top AS (SELECT * FROM every WHERE score >= 20), found AS (SELECT qid, count(*) AS n FROM top GROUP BY qid),
{LACKING},
per AS (SELECT e.qid, min(CASE WHEN list_contains(gold, source_id) THEN rank END) AS first, bool_or(list_contains(gold, source_id) OR fact_id = gold_fact) AS hit, count(DISTINCT source_id) AS diversity, bool_or((bare OR source_id = '') AND score >= 20) AS bare
  FROM every e JOIN questions q USING (qid) GROUP BY e.qid),
rows_ AS (SELECT q.qid, unanswerable, first, coalesce(hit, false) AS hit, coalesce(diversity, 0) AS diversity, coalesce(bare, false) AS bare, f.n IS NULL OR l.qid IS NOT NULL AS refused
  FROM questions q LEFT JOIN per p USING (qid) LEFT JOIN found f ON f.qid = q.qid LEFT JOIN lacking l ON l.qid = q.qid)
SELECT count(*) AS n_questions, round(avg(CAST(first IS NOT NULL AS INT)) FILTER (NOT unanswerable), 6) AS recall_at_k, round(avg(coalesce(1.0 / first, 0)) FILTER (NOT unanswerable), 6) AS mrr, round(avg(CAST(hit AS INT)) FILTER (NOT unanswerable), 6) AS hit_rate,
  round(avg(diversity), 6) AS source_diversity, round(avg(CAST(refused AS INT)) FILTER (unanswerable), 6) AS refusal_rate, round(avg(CAST(refused OR NOT bare AS INT)), 6) AS citation_rate FROM rows_""",
}
