"""A stored inverted index: postings in buckets of terms, additions as segments, segments merged by level."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.operators import retrieval as R
from evidentia.plans.shared import delete, written
from evidentia.plans.versions import Versions

#: Buckets of terms, and segments of one level that become one of the next.
BUCKETS, FAN_IN = 32, 4
#: Tokens, as a bound of postings, that a task writes; a bucket with more takes several tasks by document.
TOKENS_A_TASK = 4 << 20
#: Asked terms that are handed to the scan as literals.
PUSHED_TERMS = 100
_MANIFEST = "segment string, level int, n_docs long, total_length long"


@dataclass(frozen=True)
class Segment:
    name: str
    level: int
    n_docs: int
    total_length: int


class Index:
    """BM25 postings of a growing document set in a folder that all executors share.

    ``postings/segment=S/bucket=B`` holds ``(term, doc, tf, length)`` in order of terms, ``terms/segment=S/bucket=B`` each term's number of
    documents there. An addition writes its own segment and a new version of the manifest, which lists segments with their
    documents and tokens; readers of an older version find its segments until ``vacuum``. FAN_IN segments of a level are
    merged into one of the next, so n additions write each posting about log n times. A search reads the
    buckets of the asked terms alone.

    Documents are added once; ids are taken as unique. A document without tokens counts among documents. Writers take turns.
    """

    def __init__(self, spark: SparkSession, path: str, tokens: R.Tokenizer = T.tokens) -> None:
        self.spark, self.path, self.tokens = spark, path.rstrip("/"), tokens
        self.versions = Versions(spark, path, _MANIFEST)

    def segments(self, version: int | None = None) -> list[Segment]:
        return sorted((Segment(*r) for r in self.versions.rows(version)), key=lambda s: (s.level, s.name))

    def _publish(self, segments: list[Segment]) -> None:
        self.versions.publish([(s.name, s.level, s.n_docs, s.total_length) for s in segments])

    def _store(self, postings: DataFrame, terms: DataFrame, total_length: int) -> str:
        """Writes a segment; each file of a bucket is in order of terms. Postings of a bucket come from as many tasks as ``total_length`` tokens need."""
        name = uuid.uuid4().hex
        parts = -(-total_length // (BUCKETS * TOKENS_A_TASK)) or 1
        for kind, rows in (("postings", postings.repartition(BUCKETS * parts, "bucket", F.pmod(F.xxhash64("doc"), F.lit(parts)))), ("terms", terms.repartition(BUCKETS, "bucket"))):
            rows.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{self.path}/{kind}/segment={name}")
        return name

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
        """Adds documents as one segment, cutting each text into tokens once; then merges full levels."""
        words = docs.select(F.col(id_col).alias("doc"), self.tokens(F.col(text_col)).alias("words"))
        mark = "\0"  # no text has this token: it carries each document's length
        rows = words.select("doc", F.size("words").alias("length"), F.explode(F.array_append("words", F.lit(mark))).alias("term"))
        counted = written(rows.groupBy("doc", "term").agg(F.count("*").alias("tf"), F.first("length").alias("length")), "postings")
        n_docs, total = counted.filter(F.col("term") == mark).agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
        postings = counted.filter(F.col("term") != mark).withColumn("bucket", bucket(F.col("term")))
        name = self._store(postings, postings.groupBy("bucket", "term").agg(F.count("*").alias("df")), total)
        delete(counted)
        self._publish([*self.segments(), Segment(name, 0, n_docs, total)])
        self._merge()
        return self

    def _merge(self) -> None:
        """While FAN_IN segments share a level, they become one of the next: buckets are read and written, no text is."""
        while full := [level for level in {s.level for s in self.segments()} if sum(s.level == level for s in self.segments()) >= FAN_IN]:
            level = min(full)
            old = [s for s in self.segments() if s.level == level]
            terms = self._read("terms", old).groupBy("bucket", "term").agg(F.sum("df").alias("df"))
            total = sum(s.total_length for s in old)
            name = self._store(self._read("postings", old), terms, total)
            merged = Segment(name, level + 1, sum(s.n_docs for s in old), total)
            self._publish([*(s for s in self.segments() if s.level != level), merged])

    def vacuum(self, keep: int = 1) -> None:
        """Deletes all but the last ``keep`` versions, and the segments that none of those has."""
        live = {s.name for v in self.versions.keep_last(keep) for s in self.segments(v)}
        for kind in ("postings", "terms"):
            for name in self.versions.names(kind):
                if name.removeprefix("segment=") not in live:
                    self.versions.drop(kind, name)

    def _read(self, kind: str, segments: list[Segment]) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.path}/{kind}/segment={s.name}") for s in segments if self._has(kind, s)]
        if not parts:
            raise ValueError("the index has no tokens")
        return reduce(DataFrame.unionByName, parts)

    def _has(self, kind: str, segment: Segment) -> bool:
        return any(n.startswith("bucket=") for n in self.versions.names(kind, f"segment={segment.name}"))

    def asked(self, kind: str, terms: DataFrame, version: int | None = None) -> DataFrame | None:
        """The rows of ``terms`` (one column ``term``, distinct): their buckets alone are read. None if the index has no tokens.

        A few terms go to the scan, too, which skips what their files' statistics rule out.
        """
        segments = [s for s in self.segments(version) if self._has(kind, s)]
        if not segments:
            return None
        terms = terms.withColumn("bucket", bucket(F.col("term")))
        rows = self._read(kind, segments).filter(F.col("bucket").isin([r[0] for r in terms.select("bucket").distinct().collect()]))
        few = [r[0] for r in terms.select("term").limit(PUSHED_TERMS + 1).collect()]
        rows = rows.filter(F.col("term").isin(few)) if len(few) <= PUSHED_TERMS else rows
        return rows.join(terms, ["bucket", "term"], "left_semi").drop("bucket")

    def bm25(self, questions: DataFrame, k: int | None = 5, k1: float = 1.5, b: float = 0.75, qid_col: str = "qid", question_col: str = "question", version: int | None = None) -> DataFrame:
        """``(qid, doc, score, rank)`` as ``retrieval.bm25`` gives it for the documents that were added."""
        if k1 <= 0 or not 0 <= b <= 1:
            raise ValueError("k1 must be positive and b in [0, 1]")
        terms = questions.select(F.col(qid_col).alias("qid"), F.explode(self.tokens(F.col(question_col))).alias("term")).groupBy("qid", "term").agg(F.count("*").alias("qtf"))
        terms = R.counted(terms)
        asked = R.counted(terms.select("term").distinct())
        segments = self.segments(version)
        n_docs, length = sum(s.n_docs for s in segments), sum(s.total_length for s in segments)
        found, postings = self.asked("terms", asked, version), self.asked("postings", asked, version)
        if found is None or postings is None:
            return R.bm25(self.spark.createDataFrame([], f"doc_id {questions.schema[qid_col].dataType.simpleString()}, text string"), questions, k, k1, b, qid_col=qid_col, question_col=question_col)
        idf = found.groupBy("term").agg(F.sum("df").alias("df")).select("term", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
        weights = R.counted(terms.join(idf, "term"))
        norm = F.col("tf") + k1 * (1 - b + b * F.col("length") / max(length / max(n_docs, 1), 1e-9))
        dealt = R.by_document(postings, n_docs, weights.select("qid").distinct().count())
        scored = dealt.join(weights, "term").groupBy("qid", "doc").agg(F.round(F.sum(F.col("qtf") * F.col("idf") * F.col("tf") * (k1 + 1) / norm), R.DIGITS).alias("score"))
        return R.ranked(scored.filter("score > 0"), k, ["qid"], F.desc("score"), F.asc("doc"))


def bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")
