"""Batch retrieval: BM25 and dense top-k, score fusion, evidence allocation, reranking, the answer gate and its evaluation.

Every operator answers a table of questions at once; one question is a table of one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators.dense import DIGITS, top_k
from evidentia.plans.shared import written, written_bytes

#: A column function from text to its tokens.
Tokenizer = Callable[[Column], Column]
#: Rows, and bytes as written, of a side that may be broadcast; larger sides are joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
#: Pairs of a question and a document that a task adds up.
PAIRS_A_TASK = 1 << 20


def counted(df: DataFrame) -> DataFrame:
    """``df``, written, and marked for broadcast if it has at most BROADCAST_ROWS rows in BROADCAST_BYTES: for question sets and what is made of them."""
    out = written(df, "counted")
    small = out.count() <= BROADCAST_ROWS and written_bytes(out) <= BROADCAST_BYTES
    return F.broadcast(out) if small else out


def ranked(df: DataFrame, k: int | None, by: list[str], *order: Column) -> DataFrame:
    """``df`` with ``rank`` within ``by``; the first k rows, which Spark limits before the shuffle."""
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return out if k is None else out.filter(F.col("rank") <= k)


def postings(docs: DataFrame, id_col: str, text_col: str, tokens: Tokenizer = T.tokens) -> DataFrame:
    """``(doc, term, tf, length)``: term counts of each document and its number of tokens."""
    words = docs.select(F.col(id_col).alias("doc"), tokens(F.col(text_col)).alias("words"))
    words = words.select("doc", F.size("words").alias("length"), F.explode("words").alias("term"))
    return words.groupBy("doc", "term").agg(F.count("*").alias("tf"), F.first("length").alias("length"))


def corpus_statistics(docs: DataFrame, id_col: str, text_col: str, tokens: Tokenizer = T.tokens) -> DataFrame:
    """One row ``(n_docs, total_length)`` over all documents, empty ones included."""
    return docs.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum(F.size(tokens(F.col(text_col)))), F.lit(0)).alias("total_length"))


def term_statistics(posts: DataFrame, n_docs: int) -> DataFrame:
    """``(term, df, idf)``, idf = ln(1 + (N - df + 0.5) / (df + 0.5))."""
    return posts.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)))


def matching_postings(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, tokens: Tokenizer = T.tokens) -> tuple[DataFrame, DataFrame]:
    """``(posts, stats)``: postings (doc, term, tf, length) of ``terms`` alone, and one row (n_docs, total_length) of all documents.

    Texts are cut into tokens once. Each document has a row of its own, under a term that no text has, which tells its length;
    all other tokens meet the terms before anything is shuffled. Both tables are read from what one pass has written.
    """
    mark = "\0"
    words = docs.select(F.col(id_col).alias("doc"), tokens(F.col(text_col)).alias("words"))
    words = words.select("doc", F.size("words").alias("length"), F.explode(F.array_append("words", F.lit(mark))).alias("term"))
    asked = counted(terms.union(docs.sparkSession.createDataFrame([(mark,)], "term string")))
    met = words.join(asked, "term", "left_semi").groupBy("doc", "term").agg(F.count("*").alias("tf"), F.first("length").alias("length"))
    found = written(met, "postings")
    stats = found.filter(F.col("term") == mark).agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_length"))
    return found.filter(F.col("term") != mark), stats


def by_document(posts: DataFrame, n_docs: int, n_questions: int) -> DataFrame:
    """Postings dealt by ``doc`` to as many tasks as the pairs of questions and documents need.

    What is summed by question and document after a join with the questions is then summed where it is joined: postings are shuffled, not
    postings times the questions that ask for their term.
    """
    tasks = -(-n_docs * n_questions // PAIRS_A_TASK)
    return posts.repartition(max(posts.sparkSession.sparkContext.defaultParallelism, tasks), "doc")


def bm25(docs: DataFrame, questions: DataFrame, k: int | None = 5, k1: float = 1.5, b: float = 0.75, id_col: str = "doc_id", text_col: str = "text", qid_col: str = "qid", question_col: str = "question", tokens: Tokenizer = T.tokens) -> DataFrame:
    """``(qid, doc, score, rank)``: BM25 over question tokens with multiplicity; only positive scores, ties by document id.

    Only terms of questions are looked at: they meet the tokens before these are counted, so the
    shuffle carries matching terms alone, once, by document (``by_document``). Ids are taken as unique. Blank questions have no rows.
    """
    if k1 <= 0 or not 0 <= b <= 1:
        raise ValueError("k1 must be positive and b in [0, 1]")
    asked = questions.select(F.col(qid_col).alias("qid"), F.explode(tokens(F.col(question_col))).alias("term")).groupBy("qid", "term").agg(F.count("*").alias("qtf"))
    posts, stats = matching_postings(docs, asked.select("term").distinct(), id_col, text_col, tokens)
    n_docs, length = stats.first()
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = counted(posts.groupBy("term").agg(F.count("*").alias("df")).join(asked, "term").select("term", "qid", "qtf", idf.alias("idf")))
    met = by_document(posts, n_docs, weights.select("qid").distinct().count()).join(weights, "term")
    norm = F.col("tf") + k1 * (1 - b + b * F.col("length") / max(length / max(n_docs, 1), 1e-9))
    scored = met.groupBy("qid", "doc").agg(F.round(F.sum(F.col("qtf") * F.col("idf") * F.col("tf") * (k1 + 1) / norm), DIGITS).alias("score"))
    return ranked(scored.filter("score > 0"), k, ["qid"], F.desc("score"), F.asc("doc"))


def dense(vectors: DataFrame, queries: DataFrame, k: int | None = 5, id_col: str = "vec_id", vector_col: str = "embedding", qid_col: str = "qid", query_col: str = "query") -> DataFrame:
    """``(qid, id, score, rank)``: the k largest exact inner products for each query, ties by id; see ``dense.top_k``."""
    return top_k(vectors, queries, k, id_col, vector_col, qid_col, query_col)


def once(column: Column, use: Callable[[Column], Column]) -> Column:
    """``use(column)``, with the column evaluated once however often it is used: Spark repeats an expression in each lambda, for each element."""
    return F.transform(F.array(column), use)[0]


def l2_normalised(vector: Column) -> Column:
    """The vector over its length, as floats; a zero vector stays."""
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    over = lambda v, n: F.when(n > 0, F.transform(v, lambda x: (x / n).cast("float"))).otherwise(F.transform(v, lambda x: x.cast("float")))
    return once(vector, lambda v: once(length(v), lambda n: over(v, n)))


_MODELS: dict[tuple[str, str], Callable] = {}


def _of(load: Callable[[], Callable], name: str) -> tuple[str, str]:
    """What a worker knows a model by: workers outlive a query, and another ``load`` may have the same name."""
    return name, hashlib.sha256(CloudPickleSerializer().dumps(load)).hexdigest()


def loaded(load: Callable[[], Callable], name: tuple[str, str]) -> Callable:
    """What ``load`` gives, loaded once by each worker process under a name."""
    if name not in _MODELS:
        _MODELS[name] = load()
    return _MODELS[name]


def _by_length(model: Callable, rows: list, size: Callable, at_once: int) -> list:
    """The model's results for rows in order, asked in groups of like size so that little is padded."""
    order = sorted(range(len(rows)), key=lambda i: size(rows[i]))
    out: list = [None] * len(rows)
    for at in range(0, len(order), at_once):
        part = order[at : at + at_once]
        for i, value in zip(part, model([rows[i] for i in part]), strict=True):
            out[i] = value
    return out


def encoder(load: Callable[[], Callable], name: str, normalise: bool = True, at_once: int = 64) -> Callable[[Column], Column]:
    """A column function from a batch model ``list of texts -> list of vectors``: the seam for any encoder.

    ``load`` makes the model; only ``load`` itself is sent to workers, and each calls it once for all its tasks and batches.
    """

    name = _of(load, name)

    @F.pandas_udf("array<float>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = _by_length(loaded(load, name), texts.fillna("").tolist(), len, at_once)
            vectors = np.asarray(found, np.float64).reshape(len(texts), -1)
            lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            yield pd.Series(list((vectors / np.where(lengths > 0, lengths, 1.0) if normalise else vectors).astype(np.float32)))

    return encoded


def pair_scorer(load: Callable[[], Callable], name: str, at_once: int = 64) -> Callable[[Column, Column], Column]:
    """A column function of (question, text) from a batch model ``list of pairs -> list of scores``, loaded as by ``encoder``: the seam for any reranker."""

    name = _of(load, name)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for questions, texts in batches:
            pairs = list(zip(questions.fillna(""), texts.fillna(""), strict=True))
            yield pd.Series(_by_length(loaded(load, name), pairs, lambda p: len(p[0]) + len(p[1]), at_once), dtype="float64")

    return scored


def max_normalised(scores: DataFrame) -> DataFrame:
    """Scores divided by the greatest of their question; null for those that aren't positive, all 1 if none is."""
    top = F.max("score").over(Window.partitionBy("qid"))
    return scores.withColumn("score", F.when(top <= 0, F.lit(1.0)).when(F.col("score") > 0, F.col("score") / top))


def fuse(left: DataFrame, right: DataFrame, weights: tuple[float, float] = (0.6, 0.4)) -> DataFrame:
    """``(qid, id, score, kind, dense_score, sparse_score)``: weighted sum of max-normalised dense and sparse scores ``(qid, id, score)``.

    Rows of either side stay, also those whose score counts nothing. The kind is that of both only if both scores count.
    """
    a = max_normalised(left.select("qid", "id", "score")).select("qid", "id", F.col("score").alias("dense"), F.lit(True).alias("a"))
    b = max_normalised(right.select("qid", "id", "score")).select("qid", "id", F.col("score").alias("sparse"))
    both = a.join(b, ["qid", "id"], "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    score = F.round(weights[0] * zero("dense") + weights[1] * zero("sparse"), DIGITS)
    kind = F.when(F.col("dense").isNotNull() & F.col("sparse").isNotNull(), "vector+bm25").when(F.col("a"), "vector").otherwise("bm25")
    return both.select("qid", "id", score.alias("score"), kind.alias("kind"), zero("dense").alias("dense_score"), zero("sparse").alias("sparse_score"))


def characters(value: Column) -> Column:
    """The distinct word characters of a text."""
    return F.array_distinct(F.filter(F.split(value, ""), lambda c: c.rlike(T.TOKEN)))


def query_overlap(question: Column, text: Column) -> Column:
    """The share of the question's distinct word characters that the text has."""
    own = characters(question)
    return F.size(F.array_intersect(own, F.array_distinct(F.split(text, "")))) / F.greatest(F.size(own), F.lit(1))


def allocate(evidence: DataFrame, budget: int) -> DataFrame:
    """The evidence rows of each question that fill the budget, in order, with ``allocation_score`` and ``place``.

    ``evidence``: (qid, question, id, source_id, score, text, confidence, kind, retrieval_score). The best row of an id counts. Sources
    take turns: a source's first row before any other's second, each by allocation score. If the budget is over
    one and no graph row was taken, the best graph row replaces the last.
    """
    bonus = F.when(F.col("confidence") == "high", 0.15).when(F.col("confidence") == "medium", 0.08).otherwise(0.0)
    scored = evidence.withColumn("allocation_score", F.round(F.col("score") + 0.2 * query_overlap(F.col("question"), F.col("text")) + bonus, DIGITS))
    best = ranked(scored, 1, ["qid", "id"], F.desc("allocation_score")).drop("rank")
    turn = F.row_number().over(Window.partitionBy("qid", "source_id").orderBy(F.desc("allocation_score"), F.asc("id")))
    by_turn = best.withColumn("turn", turn).filter(F.col("turn") <= budget)
    taken = ranked(by_turn, budget, ["qid"], F.asc("turn"), F.desc("allocation_score"), F.asc("id")).withColumnRenamed("rank", "place")
    if budget <= 1:
        return taken.drop("turn")
    marks = taken.groupBy("qid").agg(F.bool_or(F.startswith("kind", F.lit("graph"))).alias("has_graph"), F.max("place").alias("last"))
    graph = best.filter(F.startswith("kind", F.lit("graph")))
    graph = ranked(graph, 1, ["qid"], F.desc(F.coalesce("retrieval_score", "allocation_score")), F.desc("allocation_score"), F.asc("id")).drop("rank")
    swap = graph.join(marks.filter("not has_graph"), "qid").withColumn("place", F.col("last"))
    kept = taken.drop("turn").join(swap.select("qid", "place"), ["qid", "place"], "left_anti")
    return kept.unionByName(swap.select(*kept.columns))


def rerank(evidence: DataFrame, scorer: Callable[[Column, Column], Column], k: int | None) -> DataFrame:
    """Scores of (question, text) pairs replace the scores, which become ``retrieval_score``; no k keeps all."""
    new = evidence.withColumn("retrieval_score", F.col("score")).withColumn("score", F.round(scorer(F.col("question"), F.col("text")), DIGITS))
    return ranked(new, k or None, ["qid"], F.desc("score"), F.asc("id"))


REFUSAL = "当前数据集中没有足够依据回答。"
# Terms that a question may ask for, and the sets of terms of which one has to stand in some evidence.
SUPPORT_RULES = (
    (("游客数量",), (("游客数量",), ("客流量",))),
    (("客流量",), (("游客数量",), ("客流量",))),
    (("门票",), (("门票",), ("票价",))),
    (("票价",), (("门票",), ("票价",))),
    (("营业收入",), (("营业收入",),)),
    (("开放时间",), (("开放时间",),)),
    (("实时天气",), (("实时天气",),)),
    (("保护评估", "得分"), (("保护评估", "得分"),)),
    (("专项保护资金",), (("专项保护资金",),)),
    (("保护评估", "日期"), (("保护评估", "日期"),)),
    (("保护规划文号",), (("保护规划文号",),)),
    (("出土地点",), (("出土地点",),)),
    (("入藏日期",), (("入藏日期",),)),
    (("文物定级",), (("文物定级",),)),
    (("修复", "日期"), (("修复", "日期"),)),
    (("国家级奖项",), (("国家级奖项",),)),
    (("正式弟子",), (("正式弟子",),)),
    (("公开传习活动",), (("公开传习活动",),)),
    (("代表作品目录",), (("代表作品目录",),)),
    (("官方更新", "日期"), (("官方更新", "日期"),)),
    (("年度统计数据",), (("年度统计数据",),)),
    (("正式审查", "结论"), (("正式审查", "结论"),)),
    (("档案编号",), (("档案编号",),)),
)


def _all_in(text: Column, terms) -> Column:
    return reduce(lambda a, b: a & b, (F.contains(text, F.lit(t)) for t in terms))


def answer(questions: DataFrame, evidence: DataFrame, minimum_score: float = 0.2, rules=SUPPORT_RULES, backend: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(qid, refused, answer, n_evidence)``: refused without reliable evidence, or if the question asks for terms that none supports.

    Else the cited evidence, line by line, or what ``backend`` makes of the question and these lines.
    """
    reliable = evidence.filter(F.col("score") >= minimum_score)
    supports = [F.bool_or(reduce(lambda a, b: a | b, (_all_in(F.col("text"), o) for o in options))).alias(f"r{i}") for i, (_, options) in enumerate(rules)]
    line = F.concat(F.lit("- "), "text", F.lit(" ["), "source_id", F.lit("]("), F.coalesce("source_url", F.lit("")), F.lit(")"))
    cited = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda x: x["line"]), "\n")
    found = reliable.groupBy("qid").agg(F.count("*").alias("n"), cited.alias("cited"), *supports)
    both = questions.select("qid", "question").join(found, "qid", "left")
    lacking = reduce(lambda a, b: a | b, (_all_in(F.col("question"), terms) & ~F.coalesce(F.col(f"r{i}"), F.lit(False)) for i, (terms, _) in enumerate(rules)))
    refused = F.col("n").isNull() | lacking
    told = backend(F.col("question"), F.col("cited")) if backend else F.concat(F.lit("当前数据集中检索到以下可溯源证据：\n"), "cited")
    text = F.when(refused, F.lit(REFUSAL)).otherwise(told)
    return both.select("qid", refused.alias("refused"), text.alias("answer"), F.when(refused, F.lit(0)).otherwise(F.col("n")).cast("long").alias("n_evidence"))


def evaluate(results: DataFrame, questions: DataFrame, k: int = 5, minimum_score: float = 0.2, rules=SUPPORT_RULES) -> DataFrame:
    """One row of means over a benchmark: recall, reciprocal rank and hit rate of answerable questions, source diversity of all, refusals of unanswerable ones, cited answers.

    ``results``: evidence (qid, rank, score, text, source_id, source_url, fact_id), of which all rows count; ``questions``: (qid, question,
    gold_sources, gold_facts, unanswerable). Recall is 1 if some gold source is found, a hit if a source or a fact is. A refusal
    counts as cited; an answer if each reliable row has a source and an address. A mean over no question is null.
    """
    met = results.join(questions.select("qid", "gold_sources", "gold_facts"), "qid")
    good = F.coalesce(F.array_contains("gold_sources", F.col("source_id")), F.lit(False))
    known = F.coalesce(F.array_contains("gold_facts", F.col("fact_id")), F.lit(False))
    bare = (F.coalesce("source_id", F.lit("")) == "") | (F.coalesce("source_url", F.lit("")) == "")
    per = met.groupBy("qid").agg(
        F.min(F.when(good, F.col("rank"))).alias("first"), F.bool_or(good | known).alias("hit"), F.count_distinct("source_id").alias("diversity"),
        F.bool_or(bare & (F.col("score") >= minimum_score)).alias("bare"),
    )
    answers = answer(questions, results, minimum_score, rules).select("qid", "refused")
    rows = questions.select("qid", "unanswerable").join(per, "qid", "left").join(answers, "qid", "left")
    asked = ~F.col("unanswerable")
    mean = lambda c: F.round(F.avg(c), DIGITS)
    number = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    return rows.agg(
        F.count("*").alias("n_questions"), mean(F.when(asked, number(F.col("first").isNotNull()))).alias("recall_at_k"), mean(F.when(asked, F.coalesce(1 / F.col("first"), F.lit(0.0)))).alias("mrr"),
        mean(F.when(asked, number(F.col("hit")))).alias("hit_rate"), mean(F.coalesce("diversity", F.lit(0))).alias("source_diversity"),
        mean(F.when(F.col("unanswerable"), F.col("refused").cast("int"))).alias("refusal_rate"), mean((F.col("refused") | ~F.coalesce("bare", F.lit(False))).cast("int")).alias("citation_rate"),
    )


def examples(results: DataFrame, questions: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` questions by id with the sources that were found for them."""
    first = questions.select("qid", "question").orderBy("qid").limit(n)
    found = results.join(F.broadcast(first.select("qid")), "qid").groupBy("qid").agg(F.array_sort(F.collect_set("source_id")).alias("sources"))
    return first.join(found, "qid", "left").select("qid", "question", F.coalesce("sources", F.array().cast("array<string>")).alias("sources"))
