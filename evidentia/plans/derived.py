"""Registered queries for graph retrieval, chunks, questions and reviews, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.functions.ids import qa_sha256
from evidentia.operators import chunking as C
from evidentia.operators import entities as E
from evidentia.operators import graph as G
from evidentia.operators import qa as Q
from evidentia.operators import validate
from evidentia.plans import views as V
from evidentia.plans.relational import _KEY, ENTITIES
from evidentia.plans.shared import written

CUES = {"located_in": ("located", "where"), "belongs_to_category": ("category", "kind")}


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.facts(spark, sf_dir).withColumns({"subject_name": T.entity_name(F.col("subject")), "object_name": T.entity_name(F.col("object"))})


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few stated questions about suppliers, and one about a nation."""
    s = V.table(spark, sf_dir, "supplier").filter("s_suppkey % 100 = 0").select(F.col("s_suppkey").alias("qid"), F.concat(F.lit("where is Supplier#"), F.col("s_suppkey").cast("string"), F.lit(" located")).alias("question"))
    return s.union(V.table(spark, sf_dir, "nation").filter("n_nationkey = 3").select(F.lit(-1).cast("long"), F.concat(F.lit("which category and where: "), "n_name")))


def _all_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question about each supplier."""
    return V.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("qid"), F.concat(F.lit("where is Supplier#"), F.col("s_suppkey").cast("string"), F.lit(" located")).alias("question"))


ALL_QUESTIONS = "questions AS (SELECT s_suppkey AS qid, 'where is Supplier#' || s_suppkey || ' located' AS question FROM supplier)"
QUESTIONS = """questions AS (SELECT s_suppkey AS qid, 'where is Supplier#' || s_suppkey || ' located' AS question FROM supplier WHERE s_suppkey % 100 = 0
  UNION ALL SELECT -1, 'which category and where: ' || n_name FROM nation WHERE n_nationkey = 3)"""
MENTIONS = """names AS (SELECT 'entity:' || substr(sha256(type || chr(0) || name), 1, 16) AS node, unnest(list_distinct(list_concat([name], aliases))) AS mention FROM entities),
found AS (SELECT qid, node, max_by(mention, (length(mention), mention)) AS mention FROM questions, names WHERE mention <> '' AND contains(question, mention) GROUP BY qid, node),
asked_nodes AS (SELECT * FROM found f WHERE NOT EXISTS (SELECT 1 FROM found o WHERE o.qid = f.qid AND o.mention <> f.mention AND contains(o.mention, f.mention)))"""


def mention_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.mentions(_questions(spark, sf_dir), E.build_entities(V.facts(spark, sf_dir)))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _facts(spark, sf_dir)
    return G.build_graph(E.build_entities(f), f, V.sources(spark, sf_dir))[0]


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _facts(spark, sf_dir)
    return G.build_graph(E.build_entities(f), f, V.sources(spark, sf_dir))[1]


def graph_khop(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = written(_facts(spark, sf_dir), "facts")
    entities = written(E.build_entities(f).select("name", "type", "aliases"), "entities")
    return G.khop(G.mentions(_all_questions(spark, sf_dir), entities), G.build_graph(entities, f, V.sources(spark, sf_dir))[1], 2)


def graph_retrieve(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = written(_facts(spark, sf_dir), "facts")
    found = G.graph_retrieve(_questions(spark, sf_dir), E.build_entities(f), f, V.sources(spark, sf_dir), 8, 1, CUES)
    return found.select("qid", "fact_id", "predicate", "source_id", "distance", "score", "rank", "text", "source_title")


EDGES = f"""ends AS (SELECT *, 'entity:' || substr(sha256(subject_type || chr(0) || {_KEY.format("subject")}), 1, 16) AS u, 'entity:' || substr(sha256(object_type || chr(0) || {_KEY.format("object")}), 1, 16) AS v FROM facts),
edges AS (SELECT u, v, predicate, fact_id FROM ends UNION ALL SELECT u, 'source:' || evidence_source_id, 'supported_by', fact_id FROM ends WHERE evidence_source_id IN (SELECT source_id FROM sources)),
steps AS (SELECT u, v FROM edges UNION SELECT v, u FROM edges)"""


def _reach(hops: int) -> str:
    out = "r0 AS (SELECT DISTINCT qid, node, 0 AS distance FROM asked_nodes)"
    for k in range(1, hops + 1):
        out += f",\nr{k} AS (SELECT qid, node, min(distance) AS distance FROM (SELECT * FROM r{k - 1} UNION ALL SELECT DISTINCT qid, v, {k} FROM r{k - 1} JOIN steps ON u = node) GROUP BY qid, node)"
    return out


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = V.table(spark, sf_dir, "documents").filter("source is not null")
    return d.select(F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("doc_id"), F.concat(F.lit("src_"), "source").alias("source_id"), "text")


def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.split_documents(V.table(spark, sf_dir, "documents")).select("doc_id", "char_start", "char_end", F.sha2("text", 256).alias("sha"))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities of the facts, and some whose names are words of nearly all texts."""
    rows = [("the", "CATEGORY", ["and", "of"]), ("de", "REGION", ["les"]), ("der", "REGION", []), ("worthless", "TOPIC", ["idiot", ""])]
    common = spark.createDataFrame(rows, "name string, type string, aliases array<string>")
    return E.build_entities(_facts(spark, sf_dir)).select("name", "type", "aliases").union(common)


def _naming(doc_id: Column, text: Column) -> Column:
    """A text that names a part, a customer, a supplier and a nation."""
    key = lambda n: (doc_id % n).cast("string")
    return F.concat(F.lit("Part#"), key(5000), F.lit(" "), text, F.lit(" Customer#"), key(3000), F.lit(" FRANCE Supplier#"), key(300))


def infer_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = V.table(spark, sf_dir, "documents").select("doc_id", _naming(F.col("doc_id"), F.col("text")).alias("text"))
    out = C.infer_labels(docs, _names(spark, sf_dir))
    return out.select("doc_id", *(F.array_join(c, "|").alias(c) for c in ("topics", "regions", "entity_mentions")))


def open_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).withColumn("text", _naming(F.substring("doc_id", 4, 20).cast("long"), F.col("text")))
    out = C.open_chunks(docs, V.sources(spark, sf_dir), _names(spark, sf_dir))
    return out.select("chunk_id", "doc_id", "source_id", "char_start", "char_end", *(F.array_join(c, "|").alias(c) for c in ("topic_labels", "region_labels", "entity_mentions")))


def synthetic_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = C.synthetic_chunks(V.facts(spark, sf_dir), V.sources(spark, sf_dir))
    return out.select("chunk_id", "doc_id", "source_id", "text", F.array_join("entity_mentions", "|").alias("entity_mentions"))


def _flat(questions: DataFrame) -> DataFrame:
    return questions.select("question_id", "question", "answer", "answer_type", *(F.array_join(c, "|").alias(c) for c in ("evidence_fact_ids", "evidence_source_ids", "required_entities")), "difficulty", "unanswerable")


def _good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.publishable(V.facts(spark, sf_dir))


def qa_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.single_fact(_good(spark, sf_dir), None))


def qa_regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.regional(_good(spark, sf_dir), None))


def qa_multi_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.multi_hop(_good(spark, sf_dir), None))


def qa_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.comparison(_good(spark, sf_dir), 500))


def qa_unanswerable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.unanswerable(_good(spark, sf_dir), 500))


def qa_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(Q.generate(V.facts(spark, sf_dir), 200))


def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = V.facts(spark, sf_dir).select(F.col("fact_id").alias("question_id"), F.element_at(F.create_map(*map(F.lit, ("belongs_to_category", "single_fact", "made_of", "multi_hop", "located_in", "comparison"))), F.col("predicate")).alias("answer_type"))
    return Q.review_sample(q, "review_1", 60)


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Multi-hop questions, and decisions on those whose id begins with a digit below five; some are another review's, some on a missing question."""
    questions = Q.multi_hop(_good(spark, sf_dir), None).withColumns({"manual_checked": F.lit(False), "notes": F.lit("")})
    h = F.col("question_id").substr(3, 1)
    own = questions.filter(h < "5").select(F.when(h == "4", "other").otherwise("review_1").alias("review_id"), F.lit("batch_007").alias("batch_id"), "question_id", qa_sha256().alias("qa_sha256"), F.lit("2024-01-02").alias("reviewed_at"), F.lit("r").alias("reviewer"))
    lost = own.filter("review_id = 'other'").withColumn("question_id", F.lit("q_missing"))
    return written(questions, "questions"), written(own.unionByName(lost).unionByName(own.filter(h == "3")), "decisions")


def review_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    questions, decisions = _reviewed(spark, sf_dir)
    return Q.apply_review(questions, decisions, qa_sha256(), 1, "review_1")[0].select("question_id", "manual_checked", "notes")


def review_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of a part of the questions have changed since, one question is gone, and one has decisions on two texts."""
    questions, decisions = _reviewed(spark, sf_dir)
    changed = questions.withColumn("answer", F.when(F.col("question_id").substr(3, 1) == "2", F.concat("answer", F.lit("!"))).otherwise(F.col("answer")))
    gone = changed.filter(F.col("question_id").substr(3, 1) != "0")
    twice = decisions.unionByName(decisions.filter(F.col("question_id").substr(3, 1) == "1").withColumn("qa_sha256", F.lit("x")).withColumn("reviewed_at", F.lit("2023-01-01")))
    return Q.apply_review(gone, twice, qa_sha256(), 1_000_000, "review_1")[1]


def _batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    questions = Q.multi_hop(_good(spark, sf_dir), None).unionByName(Q.single_fact(_good(spark, sf_dir), None))
    questions = written(questions.withColumns({"manual_checked": F.col("question_id").substr(4, 1) == "7", "notes": F.lit("")}), "questions")
    h = F.col("question_id").substr(3, 1)
    decided = questions.filter(h < "4").select(F.lit("review_1").alias("review_id"), F.concat(F.lit("batch_0"), F.when(h == "1", "12").otherwise("x")).alias("batch_id"), "question_id", F.when(h == "2", "old").otherwise(qa_sha256()).alias("qa_sha256"))
    return Q.prepare_batch(questions, written(decided, "decisions"), qa_sha256(), "review_1", 40, 15)


def review_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, _ = _batch(spark, sf_dir)
    return Q.batch_decisions(batch, qa_sha256(), "review_1", "batch_013", "r", "2024-02-03")


def review_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch(spark, sf_dir)[1]


def render_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch, _ = _batch(spark, sf_dir)
    facts = V.facts(spark, sf_dir).filter(F.col("fact_id").substr(6, 1) != "c")
    return Q.render_batch(batch, facts, V.sources(spark, sf_dir)).select("place", "question_id", F.sha2("text", 256).alias("sha"))


def audit_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked facts and questions as audit rows."""
    facts = V.facts(spark, sf_dir).withColumn("notes", F.when(F.col("n") % 2 == 0, "manual_review_id=m1; reviewed_at=2024-05-06").otherwise(""))
    questions = Q.single_fact(_good(spark, sf_dir), None)
    questions = questions.withColumns({"manual_checked": F.col("question_id").substr(3, 1) < "2", "notes": F.lit("x; qa_manual_review_id=q1; reviewed_at=2024-07-08")})
    out = validate.audit_samples(facts, questions)
    return out.select("audit_id", "record_snapshot", "snapshot_sha256", "review_method", "reviewed_at", F.array_join("source_ids", "|").alias("source_ids"))


_GOOD = "good AS (SELECT * FROM facts WHERE verified AND confidence IN ('high', 'medium'))"
RELATIONS = f"""{_GOOD},
rel AS (SELECT {_KEY.format("subject")} AS s, subject_type AS type, predicate, list_sort(list(DISTINCT {_KEY.format("object")})) AS vals, list(DISTINCT fact_id) AS fids, list(DISTINCT evidence_source_id) AS sids
  FROM good WHERE predicate IN ({", ".join(repr(p) for p in Q.SINGLE)}) GROUP BY 1, 2, 3)"""


def _case(column: str, table: dict) -> str:
    as_list = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]" if isinstance(v, list) else f"'{v}'"
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {as_list(v)}" for k, v in table.items()) + " END"


def _variant(key: str, size: str) -> str:
    digits = f"list_transform(range(1, 65), lambda i: instr('0123456789abcdef', substr(sha256({key}), CAST(i AS INT), 1)) - 1)"
    return f"list_reduce(list_prepend(0, {digits}), lambda a, d: (a * 16 + d) % {size})"


def _qa(source: str, answer: str, kind: str, facts: str, src: str, required: str, level: str, unanswerable: str = "false") -> str:
    tidy = lambda x: f"array_to_string(list_sort(list_distinct({x})), '|')"
    return f"""SELECT 'q_' || substr(sha256(question), 1, 12) AS question_id, question, {answer} AS answer, '{kind}' AS answer_type, {tidy(facts)} AS evidence_fact_ids, {tidy(src)} AS evidence_source_ids,
  array_to_string({required}, '|') AS required_entities, '{level}' AS difficulty, {unanswerable} AS unanswerable FROM ({source})"""


_LIST = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
_L = lambda c: _case(c, Q.LABELS)

_REL_SINGLE = f"SELECT *, replace(templates[CAST({_variant('type || chr(0) || s || chr(0) || predicate', 'len(templates)')} AS INT) + 1], '{{s}}', s) AS question FROM (SELECT *, CASE WHEN type = 'MUSEUM_OBJECT' AND predicate = 'belongs_to_category' THEN {_LIST(Q.MUSEUM_SINGLE['belongs_to_category'])} ELSE {_case('predicate', Q.SINGLE)} END AS templates FROM rel WHERE len(vals) = 1)"
SINGLE_SQL = _qa(_REL_SINGLE, "vals[1] || '。'", "single_fact", "fids", "sids", "[s, vals[1]]", "easy")
_REL_MULTI = f"SELECT * FROM (SELECT a.s, a.type, a.predicate AS p, b.predicate, a.vals AS v, b.vals, a.fids AS f, b.fids, a.sids AS i, b.sids, a.s || '的' || {_L('a.predicate')} || '和' || {_L('b.predicate')} || '分别是什么？' AS question, row_number() OVER (PARTITION BY a.s, a.predicate, b.predicate ORDER BY a.type DESC) AS r FROM rel a JOIN rel b ON a.s = b.s AND a.type = b.type AND a.predicate < b.predicate) WHERE r = 1"
MULTI_SQL = _qa(_REL_MULTI, f"{_L('p')} || '：' || array_to_string(v, '、') || '；' || {_L('predicate')} || '：' || array_to_string(vals, '、') || '。'", "multi_hop", "list_concat(f, fids)", "list_concat(i, sids)", "list_concat([s], list_concat(v, vals))", "hard")
_REGIONS = f"SELECT predicate, object AS region, list_sort(list(DISTINCT {_KEY.format('subject')})) AS projects, list(DISTINCT fact_id) AS fids, list(DISTINCT evidence_source_id) AS sids, {_LIST(Q.LOCATED)} AS templates FROM good WHERE predicate = 'located_in' GROUP BY 1, 2"
REGIONAL_SQL = _qa(f"SELECT *, replace(templates[CAST({_variant('predicate || chr(0) || region', 'len(templates)')} AS INT) + 1], '{{region}}', region) AS question FROM ({_REGIONS}) WHERE len(projects) <= 5", "array_to_string(projects, '、') || '。'", "regional_aggregation", "fids", "sids", "list_concat([region], projects)", "medium")
# All pairs of a type; those of the least hash first.
PAIRS = """hashed AS (SELECT s, type, sha256(type || chr(0) || s) AS h FROM (SELECT DISTINCT s, type FROM rel)),
differ AS (SELECT DISTINCT a.type, a.s AS l, b.s AS r FROM hashed a JOIN hashed b ON a.type = b.type AND a.h < b.h JOIN rel x ON x.type = a.type AND x.s = a.s AND len(x.vals) = 1 JOIN rel y ON y.type = b.type AND y.s = b.s AND y.predicate = x.predicate AND len(y.vals) = 1 AND x.vals[1] <> y.vals[1]),
pairs AS (SELECT *, sha256(type || chr(0) || l || chr(0) || r) AS o_hash FROM differ ORDER BY o_hash LIMIT {0}),
options AS (SELECT p.type, l, r, list({{'p': x.predicate, 'lv': x.vals[1], 'rv': y.vals[1], 'f': list_concat(x.fids, y.fids), 'i': list_concat(x.sids, y.sids)}} ORDER BY x.predicate) AS o
  FROM pairs p JOIN rel x ON x.type = p.type AND x.s = l AND len(x.vals) = 1 JOIN rel y ON y.type = p.type AND y.s = r AND y.predicate = x.predicate AND len(y.vals) = 1 WHERE x.vals[1] <> y.vals[1] GROUP BY 1, 2, 3),
chosen AS (SELECT *, o[CAST({1} AS INT) + 1] AS c FROM options)"""
COMPARISON_SQL = _qa(f"SELECT *, l || '和' || r || '在当前数据中的' || {_L('c.p')} || '分别是什么？' AS question FROM chosen", "l || '：' || c.lv || '；' || r || '：' || c.rv || '。'", "comparison", "c.f", "c.i", "[l, r, c.lv, c.rv]", "medium")
_PICKED = _variant("type || chr(0) || l || chr(0) || r", "len(o)")


def _unanswerable_sql(target: int) -> str:
    asked = f"SELECT replace(t, '{{s}}', s) AS question, min(s) AS s FROM (SELECT s, unnest(coalesce({_case('type', Q.UNANSWERABLE)}, {_LIST(Q.GENERIC)})) AS t FROM subjects) GROUP BY 1 ORDER BY sha256(question) LIMIT {target}"
    return _qa(asked, f"'{Q.REFUSAL}'", "unanswerable", "CAST([] AS VARCHAR[])", "CAST([] AS VARCHAR[])", "[s]", "hard", "true")


SUBJECTS = f"subjects AS (SELECT DISTINCT {_KEY.format('subject')} AS s, subject_type AS type FROM good)"
_JSON = lambda c: f"""'[' || CASE WHEN {c} = '' THEN '' ELSE '"' || replace({c}, '|', '", "') || '"' END || ']'"""
#: The hash of a question's key-sorted JSON; none of the values has a character that JSON escapes.
QA_SHA = f"""sha256('{{"answer": "' || answer || '", "answer_type": "' || answer_type || '", "difficulty": "' || difficulty || '", "evidence_fact_ids": ' || {_JSON('evidence_fact_ids')} || ', "evidence_source_ids": ' || {_JSON('evidence_source_ids')}
  || ', "question": "' || question || '", "question_id": "' || question_id || '", "required_entities": ' || {_JSON('required_entities')} || ', "unanswerable": ' || CAST(unanswerable AS VARCHAR) || '}}')"""
#: The review sample of 24 single-fact and 16 multi-hop questions, with decisions by the first digit of the id, and the next batch of it.
BATCH = f"""q AS (SELECT *, {QA_SHA} AS sha, substr(question_id, 3, 1) AS d, sha256('review_1:' || question_id) AS h FROM ({SINGLE_SQL} UNION ALL {MULTI_SQL})),
sample AS (SELECT *, row_number() OVER (ORDER BY h, question_id) AS place, d IN ('0', '1', '3') OR substr(question_id, 4, 1) = '7' AS done FROM (SELECT *, row_number() OVER (PARTITION BY answer_type ORDER BY h, question_id) AS r FROM q) WHERE r <= CASE answer_type WHEN 'single_fact' THEN 24 ELSE 16 END),
batch AS (SELECT * FROM sample WHERE NOT done ORDER BY place LIMIT 15)"""
# Chunks of whole texts: the recursion of the splitter, a row for each chunk; the driver's texts break at line ends only.
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
SPLIT = rf"""bare AS (SELECT doc_id, trim(text, {_WS}) AS t FROM {{0}} WHERE text IS NOT NULL),
marks AS (SELECT doc_id, i, c IN ('。', '！', '？', '；', chr(10)) AS mark, coalesce(lead(c) OVER (PARTITION BY doc_id ORDER BY i) IN ('。', '！', '？', '；', chr(10)), false) AS next_ FROM (SELECT doc_id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS i FROM bare WHERE length(t) > 0)),
stops AS (SELECT doc_id, list(CAST(i AS BIGINT) ORDER BY i) AS stops FROM marks WHERE mark AND NOT next_ GROUP BY doc_id),
letters AS (SELECT b.doc_id, t, length(t) AS n, coalesce(stops, CAST([] AS BIGINT[])) AS stops FROM bare b LEFT JOIN stops s ON s.doc_id = b.doc_id WHERE length(t) > 0),
steps_(doc_id, a, z, nxt) AS (
  SELECT doc_id, CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT) FROM letters
  UNION ALL
  SELECT doc_id, a, z, CASE WHEN z = n THEN NULL WHEN z - a <= 80 THEN z ELSE coalesce(list_max(list_filter(stops, lambda x: x > a AND x <= greatest(z - 80, a + 1))), greatest(z - 80, a + 1)) END
  FROM (SELECT l.doc_id, l.n, l.stops, s.nxt AS a, CASE WHEN least(s.nxt + 500, l.n) = l.n THEN l.n ELSE coalesce(list_max(list_filter(l.stops, lambda x: x > s.nxt AND x <= s.nxt + 500)), s.nxt + 500) END AS z FROM steps_ s JOIN letters l USING (doc_id) WHERE s.nxt IS NOT NULL AND s.nxt < l.n)
),
pieces AS (SELECT s.doc_id, s.a, substr(l.t, CAST(s.a + 1 AS INT), CAST(s.z - s.a AS INT)) AS p FROM steps_ s JOIN letters l USING (doc_id) WHERE s.a >= 0),
chunks AS (SELECT doc_id, CAST(a + length(p) - length(ltrim(p, {_WS})) AS INT) AS char_start, CAST(a + length(rtrim(p, {_WS})) AS INT) AS char_end, trim(p, {_WS}) AS text FROM pieces WHERE trim(p, {_WS}) <> '')"""
NAMING = "'Part#' || (doc_id % 5000) || ' ' || text || ' Customer#' || (doc_id % 3000) || ' FRANCE Supplier#' || (doc_id % 300)"
SPELLED = """mentioned AS (SELECT DISTINCT name, type, m FROM (SELECT name, type, unnest(list_concat([name], aliases)) AS m FROM (SELECT name, type, aliases FROM entities
  UNION ALL VALUES ('the', 'CATEGORY', ['and', 'of']), ('de', 'REGION', ['les']), ('der', 'REGION', []::VARCHAR[]), ('worthless', 'TOPIC', ['idiot', '']))) WHERE m <> '')"""
_HITS = """labels AS (SELECT {key}, list(DISTINCT name) FILTER (type = 'CATEGORY') AS topics, list(DISTINCT name) FILTER (type = 'REGION') AS regions, list(DISTINCT name) AS names FROM {source} JOIN mentioned ON contains(text, m) GROUP BY ALL)"""

QUERIES = {
    "w14_mention_longest": mention_longest,
    "r8_graph_nodes": graph_nodes,
    "r8_graph_edges": graph_edges,
    "r10_graph_khop": graph_khop,
    "r14_graph_retrieve": graph_retrieve,
    "t1_split_text": split_text,
    "t2_infer_labels": infer_labels,
    "t3_open_chunks": open_chunks,
    "t4_synthetic_chunks": synthetic_chunks,
    "t23_qa_single": qa_single,
    "t24_qa_regional": qa_regional,
    "t25_qa_multi_hop": qa_multi_hop,
    "t26_qa_comparison": qa_comparison,
    "t27_qa_unanswerable": qa_unanswerable,
    "t29_qa_mix": qa_mix,
    "w4_review_sample": review_sample,
    "up13_review_apply": review_apply,
    "up13_review_issues": review_issues,
    "up12_batch_decisions": review_batch,
    "up11_batch_report": review_report,
    "t30_render_batch": render_batch,
    "t20_audit_samples": audit_samples,
}

ORACLE_SQL = {
    "w14_mention_longest": f"WITH {V.FACTS}, {ENTITIES}, {QUESTIONS}, {MENTIONS} SELECT qid, node, mention FROM asked_nodes",
    "r8_graph_nodes": f"WITH {V.FACTS}, {V.SOURCES}, {ENTITIES} SELECT 'entity:' || substr(sha256(type || chr(0) || name), 1, 16) AS node, 'entity' AS kind, name FROM entities UNION ALL SELECT 'source:' || source_id, 'source', title FROM sources",
    "r8_graph_edges": f"WITH {V.FACTS}, {V.SOURCES}, {EDGES} SELECT u, v, predicate, fact_id FROM edges",
    "r10_graph_khop": f"WITH {V.FACTS}, {V.SOURCES}, {ENTITIES}, {ALL_QUESTIONS}, {MENTIONS}, {EDGES}, {_reach(2)} SELECT qid, node, distance FROM r2",
    "r14_graph_retrieve": f"""WITH {V.FACTS}, {V.SOURCES}, {ENTITIES}, {QUESTIONS}, {MENTIONS}, {EDGES}, {_reach(2)},
touched AS (SELECT u AS node, fact_id FROM edges UNION SELECT v, fact_id FROM edges),
near AS (SELECT qid, fact_id, min(distance) AS distance FROM touched JOIN r2 USING (node) GROUP BY 1, 2),
met AS (SELECT n.qid, n.fact_id, n.distance, f.predicate, f.evidence_source_id AS source_id, f.subject || ' — ' || f.predicate || ' — ' || f.object AS told, f.confidence, q.question, list_distinct(list_filter(string_split(q.question, ''), lambda c: regexp_matches(c, '[\\p{{L}}\\p{{N}}_]'))) AS own
  FROM near n JOIN facts f USING (fact_id) JOIN questions q USING (qid)),
scored AS (SELECT *, round(least(1.0, 0.5 / (1 + distance) + 0.3 * CASE confidence WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.75 WHEN 'low' THEN 0.4 ELSE 0.5 END
    + 0.2 * len(list_intersect(own, list_distinct(string_split(told, '')))) / greatest(len(own), 1)
    + CASE WHEN (predicate = 'located_in' AND (contains(question, 'located') OR contains(question, 'where'))) OR (predicate = 'belongs_to_category' AND (contains(question, 'category') OR contains(question, 'kind'))) THEN 0.2 ELSE 0 END), 6) AS score,
  CASE predicate WHEN 'located_in' THEN least(nullif(instr(question, 'located'), 0), nullif(instr(question, 'where'), 0)) * 1000 WHEN 'belongs_to_category' THEN least(nullif(instr(question, 'category'), 0), nullif(instr(question, 'kind'), 0)) * 1000 + 1 END AS cue FROM met),
held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, predicate ORDER BY score DESC, fact_id) AS r FROM scored WHERE cue IS NOT NULL) WHERE r = 1),
turns AS (SELECT s.*, coalesce(h.cue, 1099511627776) AS turn FROM scored s LEFT JOIN held h ON h.qid = s.qid AND h.fact_id = s.fact_id)
SELECT t.qid, fact_id, predicate, t.source_id, distance, score, rank, told AS text, coalesce(title, t.source_id) AS source_title FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY turn, score DESC, fact_id) AS rank FROM turns) t LEFT JOIN sources s ON s.source_id = t.source_id WHERE rank <= 8""",
    "t2_infer_labels": f"""WITH {V.FACTS}, {ENTITIES}, {SPELLED}, docs AS (SELECT doc_id, {NAMING} AS text FROM documents), {_HITS.format(source='docs', key='doc_id')}
SELECT doc_id, coalesce(array_to_string(list_sort(topics), '|'), '') AS topics, coalesce(array_to_string(list_sort(regions), '|'), '') AS regions, coalesce(array_to_string(list_sort(names), '|'), '') AS entity_mentions FROM documents LEFT JOIN labels USING (doc_id)""",
    "t4_synthetic_chunks": f"""WITH {V.FACTS}, {V.SOURCES}, {_GOOD},
said AS (SELECT subject, evidence_source_id AS source_id, string_agg(replace({_case("predicate", C.STATEMENTS)}, '{{object}}', object), '；' ORDER BY fact_id) AS said, list_sort(list_distinct(list_concat(list(DISTINCT subject), list(DISTINCT object)))) AS mentions FROM good GROUP BY 1, 2),
texts AS (SELECT 'doc_synthetic_' || substr(sha256(subject || source_id), 1, 12) AS doc_id, source_id, '以下是根据已核验结构化事实生成的中性摘要，并非来源原文：关于' || subject || '，' || said || '。依据来源编号 ' || source_id || '。' AS text, mentions FROM said WHERE source_id IN (SELECT source_id FROM sources))
SELECT 'chk_' || substr(sha256(doc_id || chr(0) || '0' || chr(0) || length(text) || chr(0) || text), 1, 12) AS chunk_id, doc_id, source_id, text, array_to_string(mentions, '|') AS entity_mentions FROM texts""",
    "t1_split_text": f"WITH RECURSIVE {SPLIT.format('documents')} SELECT doc_id, char_start, char_end, sha256(text) AS sha FROM chunks",
    "t3_open_chunks": f"""WITH RECURSIVE {V.FACTS}, {ENTITIES}, {SPELLED}, {V.SOURCES}, open_docs AS (SELECT 'doc' || doc_id AS doc_id, {NAMING} AS text FROM documents WHERE source IS NOT NULL AND 'src_' || source IN (SELECT source_id FROM sources WHERE raw_text_release AND release_policy IN ('full_text_allowed', 'government_public'))), {SPLIT.format('open_docs')},
{_HITS.format(source='chunks', key='doc_id, char_start')},
labelled AS (SELECT c.*, s.source_id, s.topic, s.region, topics, regions, names FROM chunks c JOIN (SELECT doc_id AS d_id, source FROM documents) d ON 'doc' || d.d_id = c.doc_id JOIN sources s ON s.source_id = 'src_' || d.source LEFT JOIN labels l ON l.doc_id = c.doc_id AND l.char_start = c.char_start)
SELECT 'chk_' || substr(sha256(doc_id || chr(0) || char_start || chr(0) || char_end || chr(0) || text), 1, 12) AS chunk_id, doc_id, source_id, char_start, char_end,
  array_to_string(list_sort(list_distinct(list_concat(topic, coalesce(topics, []::VARCHAR[])))), '|') AS topic_labels, array_to_string(list_sort(list_distinct(list_concat(region, coalesce(regions, []::VARCHAR[])))), '|') AS region_labels,
  coalesce(array_to_string(list_sort(names), '|'), '') AS entity_mentions FROM labelled""",
    "t23_qa_single": f"WITH {V.FACTS}, {RELATIONS} {SINGLE_SQL}",
    "t24_qa_regional": f"WITH {V.FACTS}, {_GOOD} {REGIONAL_SQL}",
    "t25_qa_multi_hop": f"WITH {V.FACTS}, {RELATIONS} {MULTI_SQL}",
    "t26_qa_comparison": f"WITH {V.FACTS}, {RELATIONS}, {PAIRS.format(500, _PICKED)} {COMPARISON_SQL}",
    "t27_qa_unanswerable": f"WITH {V.FACTS}, {_GOOD}, {SUBJECTS} {_unanswerable_sql(500)}",
    "t29_qa_mix": f"""WITH {V.FACTS}, {RELATIONS}, {SUBJECTS}, {PAIRS.format(200, _PICKED)},
p0 AS ({SINGLE_SQL}), p1 AS ({MULTI_SQL}), p2 AS ({COMPARISON_SQL}),
p3 AS ({REGIONAL_SQL}), p4 AS ({_unanswerable_sql(20)}),
ranked AS (
  SELECT 0 AS pool, *, row_number() OVER (ORDER BY question_id) AS r, 80 AS quota FROM p0 UNION ALL SELECT 1, *, row_number() OVER (ORDER BY question_id), 40 FROM p1
  UNION ALL SELECT 2, *, row_number() OVER (ORDER BY sha256(question)), 20 FROM p2 UNION ALL SELECT 3, *, row_number() OVER (ORDER BY answer_type || question_id), 40 FROM p3
  UNION ALL SELECT 4, *, row_number() OVER (ORDER BY sha256(question)), 20 FROM p4
),
phased AS (SELECT *, CASE WHEN r > quota THEN 1 ELSE 0 END AS phase FROM ranked WHERE r <= 200),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY phase, pool, r) AS k FROM phased) WHERE k = 1),
placed AS (SELECT *, row_number() OVER (ORDER BY phase, pool, r) AS place FROM once)
SELECT question_id, question, answer, answer_type, evidence_fact_ids, evidence_source_ids, required_entities, difficulty, unanswerable FROM placed WHERE phase = 0 OR place <= 200""",
    "up13_review_apply": f"""WITH {V.FACTS}, {RELATIONS}, q AS ({MULTI_SQL}), h AS (SELECT *, {QA_SHA} AS sha, substr(question_id, 3, 1) < '4' AS hit FROM q), gate AS (SELECT count_if(hit) >= 1 AS ok FROM h)
SELECT question_id, hit AND ok AS manual_checked, CASE WHEN hit AND ok THEN 'qa_manual_review_id=review_1; reviewed_at=2024-01-02; reviewer=r; qa_sha256=' || sha ELSE '' END AS notes FROM h, gate""",
    "up13_review_issues": f"""WITH {V.FACTS}, {RELATIONS}, q AS (SELECT question_id, substr(question_id, 3, 1) AS d FROM ({MULTI_SQL}))
SELECT question_id, CASE d WHEN '0' THEN 'missing_qa_record' WHEN '1' THEN 'conflicting_review_snapshots' ELSE 'qa_snapshot_changed' END AS issue FROM q WHERE d < '3' UNION ALL SELECT NULL, 'accepted_below_minimum'""",
    "up12_batch_decisions": f"""WITH {V.FACTS}, {RELATIONS}, {BATCH} SELECT 'review_1' AS review_id, 'batch_013' AS batch_id, question_id, sha AS qa_sha256, 'accepted' AS decision, '2024-02-03' AS reviewed_at, 'r' AS reviewer FROM batch""",
    "up11_batch_report": f"""WITH {V.FACTS}, {RELATIONS}, {BATCH} SELECT 'review_1' AS review_id, 40 AS target, (SELECT count_if(done) FROM sample) AS accepted, (SELECT count_if(NOT done) FROM sample) AS remaining,
  CASE WHEN (SELECT count_if(NOT done) FROM sample) > 0 THEN CASE WHEN (SELECT count_if(d = '1') FROM q) > 0 THEN 'batch_013' ELSE 'batch_001' END END AS batch_id, least((SELECT count_if(NOT done) FROM sample), 15) AS batch_size,
  (SELECT count_if(d = '2') FROM sample) AS stale, (SELECT count(*) FROM q WHERE d < '4' AND question_id NOT IN (SELECT question_id FROM sample)) AS superseded""",
    "t30_render_batch": f"""WITH {V.FACTS}, {V.SOURCES}, {RELATIONS}, {BATCH},
told AS (SELECT question_id, string_agg('  - ' || ref || CASE WHEN fact_id IS NULL THEN ': [缺失]' ELSE ': ' || subject || ' — ' || predicate || ' — ' || object || chr(10) || '    原始证据：' || evidence_text END, chr(10) ORDER BY ref) AS said
  FROM (SELECT question_id, unnest(string_split(evidence_fact_ids, '|')) AS ref FROM batch) LEFT JOIN (SELECT * FROM facts WHERE substr(fact_id, 6, 1) <> 'c') ON fact_id = ref GROUP BY question_id),
named AS (SELECT question_id, string_agg('  - ' || ref || CASE WHEN source_id IS NULL THEN ': [缺失]' ELSE ': ' || title || chr(10) || '    ' || url END, chr(10) ORDER BY ref) AS said
  FROM (SELECT question_id, unnest(string_split(evidence_source_ids, '|')) AS ref FROM batch) LEFT JOIN sources ON source_id = ref GROUP BY question_id)
SELECT place, question_id, sha256('[' || place || '/' || (SELECT count(*) FROM batch) || '] ' || question_id || ' | ' || answer_type || ' | ' || difficulty || chr(10) || '问题：' || question || chr(10) || '答案：' || answer || chr(10) || '证据事实：' || chr(10) || t.said || chr(10) || '来源：' || chr(10) || n.said) AS sha
FROM (SELECT * EXCLUDE (place), row_number() OVER (ORDER BY place) AS place FROM batch) JOIN told t USING (question_id) JOIN named n USING (question_id)""",
    "t20_audit_samples": f"""WITH {V.FACTS}, {RELATIONS}, q AS (SELECT *, {QA_SHA} AS sha FROM ({SINGLE_SQL}) WHERE substr(question_id, 3, 1) < '2'),
f AS (SELECT *, '{{"evidence_source_id":"' || evidence_source_id || '","evidence_text":"' || evidence_text || '","evidence_url":"' || evidence_url || '","fact_id":"' || fact_id || '","object":"' || object || '","predicate":"' || predicate || '","subject":"' || subject || '"}}' AS snap FROM facts WHERE n % 17 = 0)
SELECT 'audit_fact_' || fact_id AS audit_id, snap AS record_snapshot, sha256(snap) AS snapshot_sha256, CASE WHEN n % 2 = 0 THEN 'm1' ELSE 'manual_fact_review' END AS review_method, CASE WHEN n % 2 = 0 THEN '2024-05-06' ELSE '' END AS reviewed_at, evidence_source_id AS source_ids FROM f
UNION ALL SELECT 'audit_qa_' || question_id, '{{"answer":"' || answer || '","answer_type":"' || answer_type || '","difficulty":"' || difficulty || '","evidence_fact_ids":' || replace({_JSON('evidence_fact_ids')}, ', ', ',') || ',"evidence_source_ids":' || replace({_JSON('evidence_source_ids')}, ', ', ',')
  || ',"question":"' || question || '","question_id":"' || question_id || '","unanswerable":false}}', sha, 'q1', '2024-07-08', evidence_source_ids FROM q""",
    "w4_review_sample": f"""WITH {V.FACTS}, q AS (SELECT fact_id AS question_id, CASE predicate WHEN 'belongs_to_category' THEN 'single_fact' WHEN 'made_of' THEN 'multi_hop' ELSE 'comparison' END AS answer_type, sha256('review_1:' || fact_id) AS h FROM facts),
r AS (SELECT *, row_number() OVER (PARTITION BY answer_type ORDER BY h, question_id) AS r FROM q)
SELECT question_id, answer_type, row_number() OVER (ORDER BY h, question_id) AS place FROM r WHERE r <= CASE answer_type WHEN 'single_fact' THEN 30 WHEN 'multi_hop' THEN 18 ELSE 12 END""",
}
