"""Retrieval by mode: vector, BM25 and graph evidence alone, or fused, allocated and reranked together; and its evaluation."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import graph as G
from evidentia.operators import retrieval as R
from evidentia.plans.shared import written
from evidentia.plans.versions import Versions
from evidentia.sources.release import exists
from evidentia.streaming.collect import MergedTable, bucket_of

#: Every evidence row has these columns; what a kind of evidence doesn't have is null.
EVIDENCE = {
    "qid": None, "evidence_id": "string", "chunk_id": "string", "fact_id": "string", "source_id": "string", "score": "double", "text": "string", "source_url": "string",
    "kind": "string", "source_title": "string", "predicate": "string", "confidence": "string", "retrieval_score": "double", "dense_score": "double", "sparse_score": "double", "rank": "int",
}
GRAPH_ROWS = 10
#: A leaf finds the best k evidence rows for each of the questions (qid, question).
Leaf = Callable[[DataFrame, int], DataFrame]


def evidence(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` as evidence rows: given columns, its own, and nulls for the rest."""
    pick = lambda c, t: columns[c] if c in columns else F.col(c) if c in df.columns else F.lit(None)
    return df.select(*((pick(c, t) if t is None else pick(c, t).cast(t)).alias(c) for c, t in EVIDENCE.items()))


def _of_chunks(found: DataFrame, chunks: DataFrame, kind: str) -> DataFrame:
    """Evidence from ``(qid, chunk_id, score, rank)`` and the chunks (chunk_id, source_id, text, source_url)."""
    met = R.counted(found).join(chunks.select("chunk_id", "source_id", "text", "source_url"), "chunk_id")
    return evidence(met, evidence_id=F.col("chunk_id"), kind=F.lit(kind))


def vector_leaf(chunks: DataFrame, index: DataFrame, encode: Callable[[Column], Column]) -> Leaf:
    """Dense retrieval from an index (chunk_id, embedding); blank questions find nothing."""

    def find(questions: DataFrame, k: int) -> DataFrame:
        asked = questions.filter(F.trim("question") != "").select("qid", encode(F.col("question")).alias("query"))
        found = R.dense(index, asked, k, id_col="chunk_id").withColumnRenamed("id", "chunk_id")
        return _of_chunks(found, chunks, "vector")

    return find


def bm25_leaf(chunks: DataFrame, k1: float = 1.5, b: float = 0.75, tokens: R.Tokenizer = T.tokens) -> Leaf:
    def find(questions: DataFrame, k: int) -> DataFrame:
        found = R.bm25(chunks, questions, k, k1, b, id_col="chunk_id", tokens=tokens).withColumnRenamed("doc", "chunk_id")
        return _of_chunks(found, chunks, "bm25")

    return find


def graph_leaf(entities: DataFrame, facts: DataFrame, sources: DataFrame, hops: int = 2, cues: dict = G.CUES) -> Leaf:
    def find(questions: DataFrame, k: int) -> DataFrame:
        return evidence(G.graph_retrieve(questions, entities, facts, sources, k, hops, cues), evidence_id=F.col("fact_id"), kind=F.lit("graph"))

    return find


def fused(vector: DataFrame, sparse: DataFrame, weights: tuple[float, float]) -> DataFrame:
    """Chunks of either list once, with the weighted score; fields are the vector row's where there is one."""
    both = R.fuse(*(x.select("qid", F.col("evidence_id").alias("id"), "score") for x in (vector, sparse)), weights).withColumnRenamed("id", "evidence_id")
    fields = ["chunk_id", "source_id", "text", "source_url"]
    every = vector.select("qid", "evidence_id", F.lit(0).alias("side"), *fields).union(sparse.select("qid", "evidence_id", F.lit(1).alias("side"), *fields))
    one = every.groupBy("qid", "evidence_id").agg(F.min_by(F.struct(*fields), "side").alias("f")).select("qid", "evidence_id", "f.*")
    return evidence(both.join(one, ["qid", "evidence_id"]))


@dataclass
class Retriever:
    """The leaves that there are, a pair scorer for reranking, and the weights of dense and sparse scores."""

    vector: Leaf | None = None
    bm25: Leaf | None = None
    graph: Leaf | None = None
    scorer: Callable[[Column, Column], Column] | None = None
    weights: tuple[float, float] = (0.6, 0.4)

    def modes(self, rerank: bool | None = None) -> list[str]:
        """Base modes of the leaves, ``hybrid`` with two or more, then each reranked if there is a scorer (or as told)."""
        out = [f"{name}-only" for name in ("vector", "bm25", "graph") if getattr(self, name)]
        out += ["hybrid"] * (len(out) >= 2)
        return out + [f"{m}+rerank" for m in out] * (self.scorer is not None if rerank is None else rerank)

    def retrieve(self, questions: DataFrame, mode: str = "hybrid", k: int = 5, budget: int = 10) -> DataFrame:
        """Evidence rows of all ``questions`` (qid, question), in the order of ``rank``.

        Vector and BM25 modes give k rows, all others are cut to the budget. A reranked mode without a scorer is the mode itself. An
        unknown mode, or one whose leaf isn't there, is an error.
        """
        base, _, suffix = mode.partition("+")
        if base not in self.modes(False) or suffix not in ("", "rerank"):
            raise ValueError(f"no such mode: {mode}")
        again = suffix == "rerank" and self.scorer is not None
        if base != "hybrid":
            leaf = getattr(self, base.removesuffix("-only"))
            rows = leaf(questions, max(k, GRAPH_ROWS) if base == "graph-only" else k)
            rows = rows.filter(F.col("rank") <= budget) if base == "graph-only" else rows
            return self._reranked(rows, questions, budget) if again else rows
        empty = lambda: evidence(questions.limit(0))
        vector, sparse = (leaf(questions, k) if leaf else empty() for leaf in (self.vector, self.bm25))
        found = self.graph(questions, max(k, GRAPH_ROWS)) if self.graph else empty()
        # Chunk and graph rows are used several times by the allocation.
        pool = written(fused(vector, sparse, self.weights).drop("rank").unionByName(found.drop("rank")), "evidence")
        pool = self._reranked(pool.withColumn("rank", F.lit(0)), questions, None).drop("rank") if again else pool
        rows = R.allocate(pool.join(R.counted(questions.select("qid", "question")), "qid").withColumnRenamed("evidence_id", "id"), budget)
        return evidence(rows, evidence_id=F.col("id"), rank=F.col("place"))

    def _reranked(self, rows: DataFrame, questions: DataFrame, k: int | None) -> DataFrame:
        named = rows.drop("rank").join(R.counted(questions.select("qid", "question")), "qid").withColumnRenamed("evidence_id", "id")
        return evidence(R.rerank(named, self.scorer, k), evidence_id=F.col("id"))


def _once(leaf: Leaf) -> Leaf:
    """A leaf that writes what it finds: the modes of one evaluation ask the same questions."""
    known: dict[int, DataFrame] = {}

    def find(questions: DataFrame, k: int) -> DataFrame:
        if k not in known:
            known[k] = written(leaf(questions, k), "leaf")
        return known[k]

    return find


def run_evaluation(questions: DataFrame, retriever: Retriever, k: int = 5, modes: list[str] | None = None, minimum_score: float = 0.2, rules=R.SUPPORT_RULES) -> DataFrame:
    """A row of metrics for each mode that there is; ``questions`` as for ``retrieval.evaluate``. Without any leaf it is an error."""
    modes = retriever.modes() if modes is None else modes
    if not modes:
        raise ValueError("at least one index or graph is needed")
    asked = questions.select("qid", "question")
    once = replace(retriever, **{n: _once(getattr(retriever, n)) for n in ("vector", "bm25", "graph") if getattr(retriever, n)})
    rows = []
    for mode in modes:
        found = written(once.retrieve(asked, mode, k, k), "results")
        rows.append(R.evaluate(found, questions, k, minimum_score, rules).select(F.lit(mode).alias("mode"), "*"))
    return reduce(DataFrame.union, rows)


def ask(spark: SparkSession, question: str, retriever: Retriever, mode: str = "hybrid", k: int = 5, budget: int = 10, minimum_score: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """``(answer, evidence)`` for one question."""
    questions = spark.createDataFrame([(0, question)], "qid int, question string")
    found = written(retriever.retrieve(questions, mode, k, budget), "asked")
    return R.answer(questions, found, minimum_score), found.orderBy("rank")


def vector_table(spark: SparkSession, path: str) -> MergedTable:
    """The stored vectors of an index: (chunk_id, sha, embedding, turn), the last turn of a chunk counts; of a chunk that is gone the vector is null."""
    return MergedTable(spark, f"{path}/vectors", "chunk_id", "turn")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``(chunk_id, embedding)`` of the chunks that the index has."""
    return vector_table(spark, path).read().filter("embedding is not null").select("chunk_id", "embedding")


def build_index(chunks: DataFrame, path: str, encode: Callable[[Column], Column], model: str, normalised: bool = True, resume: bool = True) -> tuple[dict, bool]:
    """``(manifest, reused)``: vectors of all chunks (chunk_id, text) below ``path``.

    The manifest holds a digest of the ids and texts of each bucket of chunks. Buckets whose digest is the same are not read; in the others
    chunks that are new or have another text are encoded and written, and those that are gone are marked. The manifest tells how many
    were ``encoded`` and ``removed``; with neither the index is used again as it is. Another model or normalisation, or ``resume=False``, starts anew. Without
    chunks it is an error.
    """
    spark = chunks.sparkSession
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = chunks.select("chunk_id", "text", sha.alias("sha"), bucket_of("chunk_id").alias("bucket"))
    digest = F.concat_ws(":", F.count("*"), F.sum(F.xxhash64("chunk_id", "sha").cast("decimal(38,0)")))
    buckets = {str(r.bucket): r.digest for r in rows.groupBy("bucket").agg(digest.alias("digest")).collect()}
    if not buckets:
        raise ValueError("there are no chunks to index")
    same = {"model": model, "normalised": normalised}
    old = read_index_manifest(spark, path)
    if not (resume and old and all(old.get(k) == v for k, v in same.items())):
        old = {"buckets": {}, "turn": 0}
        Versions(spark, path, "").drop("vectors")
    changed = [int(b) for b in {*buckets, *old["buckets"]} if buckets.get(b) != old["buckets"].get(b)]
    if not changed:
        return old | {"encoded": 0, "removed": 0}, True
    table, turn = vector_table(spark, path), old["turn"] + 1
    before = table.read(buckets=changed)
    asked = rows.filter(F.col("bucket").isin(changed))
    if before is None:
        added = asked
    else:
        held = before.filter("embedding is not null").select("chunk_id", F.col("sha").alias("old_sha"))
        added = asked.join(held, "chunk_id", "left").filter("old_sha is null or old_sha <> sha")
        gone = held.join(asked, "chunk_id", "left_anti").select("chunk_id")
    now = F.lit(turn).cast("long").alias("turn")
    encoded = added.select("chunk_id", "sha", encode(F.col("text")).alias("embedding"), now)
    if before is not None:
        encoded = encoded.unionByName(gone.select("chunk_id", F.lit(None).cast("string").alias("sha"), F.lit(None).cast(encoded.schema["embedding"].dataType).alias("embedding"), now))
    table.add(encoded)
    live = F.col("embedding").isNotNull()
    fresh = F.col("turn") == turn
    count, dimension, new, removed = table.read().agg(F.count_if(live), F.max(F.size("embedding")), F.count_if(fresh & live), F.count_if(fresh & ~live)).first()
    manifest = same | {"buckets": buckets, "turn": turn, "count": count, "dimension": dimension, "encoded": new, "removed": removed}
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_manifest")
    return manifest, False


def read_index_manifest(spark: SparkSession, path: str) -> dict | None:
    return json.loads(spark.read.text(f"{path}/_manifest").first()[0]) if exists(spark, f"{path}/_manifest/_SUCCESS") else None


def open_retriever(spark: SparkSession, path: str, encoders: dict[str, Callable[[Column], Column]], scorer: Callable[[Column, Column], Column] | None = None, config: dict | None = None) -> Retriever:
    """A retriever of the tables that are there below ``path``: ``chunks``, ``index``, and ``entities`` with ``facts`` and ``sources``.

    The index's manifest names the encoder, whatever the configuration says. ``config`` has ``retrieval`` (dense_weight, sparse_weight,
    graph_hops), ``sparse`` (enabled, k1, b) and ``reranker`` (enabled).
    """
    config = config or {}
    retrieval, sparse = config.get("retrieval", {}), config.get("sparse", {})
    there = {n: spark.read.parquet(f"{path}/{n}") for n in ("chunks", "entities", "facts", "sources") if exists(spark, f"{path}/{n}/_SUCCESS")}
    manifest = read_index_manifest(spark, f"{path}/index")
    out = Retriever(weights=(float(retrieval.get("dense_weight", 0.6)), float(retrieval.get("sparse_weight", 0.4))))
    if manifest and "chunks" in there:
        out.vector = vector_leaf(there["chunks"], read_vectors(spark, f"{path}/index"), encoders[manifest["model"]])
    if sparse.get("enabled", True) and "chunks" in there:
        out.bm25 = bm25_leaf(there["chunks"], float(sparse.get("k1", 1.5)), float(sparse.get("b", 0.75)))
    if {"entities", "facts", "sources"} <= there.keys():
        out.graph = graph_leaf(there["entities"], there["facts"], there["sources"], int(retrieval.get("graph_hops", 2)))
    if config.get("reranker", {}).get("enabled", scorer is not None):
        out.scorer = scorer
    return out
