"""A quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise, small_batches

FEATURES, SEED, RIDGE = 256, 7, 1e-3
#: Sums of normal equations that one task adds up.
FAN_IN = 16
#: Bins of ridge scores, from LOW to HIGH, in which labels are summed for the calibration.
BINS, LOW, HIGH = 2000, -1.0, 2.0
NAMES = ("words", "chars", "lines", "word_length", "word_length_deviation", "words_a_line", "symbols", "upper", "digits", "marks", "exclaims", "letters", "distinct", "top_word", "repeated", "neighbours", "copied_lines", "short_words", "upper_words", "bytes_a_char")
SYMBOLS = re.compile(r"[#*$%&|<>]")
MARKS = re.compile(r"[.,;:?]")
DIGITS = re.compile(r"\d")
LETTERS = re.compile(r"[^\W\d_]")


def statistics(text: str | None) -> list[float]:
    """The numbers of NAMES for a whole text; zeros for null, empty and blank ones. They don't depend on any other row."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(NAMES)
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    chars = lengths.sum()
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    # Capitals: characters that lower-casing changes.
    lower = text.lower()
    upper = sum(a != b for a, b in zip(text, lower, strict=False)) if lower != text else 0
    return [
        math.log1p(n), math.log1p(chars), math.log1p(len(lines)), lengths.mean(), lengths.std(), math.log1p(n / max(1, len(lines))),
        len(SYMBOLS.findall(text)) / chars, upper / chars, len(DIGITS.findall(text)) / chars, len(MARKS.findall(text)) / chars, text.count("!") / n,
        len(LETTERS.findall(text)) / chars, len(counts) / n, max(counts.values()) / n, 1 - len(windows) / max(1, n - 2) if n > 2 else 0.0,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, 1 - len(set(lines)) / max(1, len(lines)), float((lengths < 3).mean()),
        sum(w.isupper() for w in words) / n, len(text.encode()) / len(text),
    ]


class Model:
    """Scores standardised statistics: Fourier features for a Gaussian kernel, beside the statistics themselves; then calibrates."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        d = len(mean)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.directions = rng.normal(0, 1 / math.sqrt(d), (d, FEATURES))
        self.phases = rng.uniform(0, 2 * math.pi, FEATURES)
        self.weights = np.zeros(FEATURES + d + 1)
        self.knots, self.values = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.deviation, -8, 8)
        waves = math.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phases)
        return np.hstack((waves, z / len(self.mean), np.ones((len(x), 1))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values)


def isotonic(scores: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of their scores: centres and rising means of the pools."""
    pools: list[list[float]] = []
    for s, y, n in zip(scores, sums, counts, strict=True):
        pools.append([s * n, y, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            a = pools.pop()
            pools[-1] = [u + v for u, v in zip(pools[-1], a, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def _arrays(batch: pa.RecordBatch, column: int) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(batch), -1) if len(batch) else np.zeros((0, len(NAMES)))


def _summed(rows: DataFrame, each) -> np.ndarray | None:
    """The sum over rows of ``each(x, y)``: each task adds up its own, then FAN_IN sums at a time are added until one is left."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from one(each(_arrays(b, 0), b.column(1).to_numpy(zero_copy_only=False)) for b in batches if len(b))

    def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from one(np.array(x) for b in batches for x in b.column(0).to_numpy(zero_copy_only=False))

    def one(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["value"])

    level = materialise(rows.mapInArrow(sums, "value array<double>"), "sums")
    while (n := level.count()) > 1:
        before, level = level, materialise(level.repartition(-(-n // FAN_IN)).mapInArrow(more, "value array<double>"), "sums")
        discard(before)
    found = level.collect()
    return np.array(found[0][0]) if found else None


def fit(labelled: DataFrame) -> Model:
    """Fits on rows ``(x array<double>, y double, fold boolean)``: sums for the standardisation, normal equations, then label sums by score bin.

    The calibration takes the rows of the fold, which the equations don't see; if either side is empty both take all.
    """
    d = len(NAMES)
    sides = {bool(r[0]) for r in labelled.select("fold").distinct().collect()}
    apart = labelled.filter("fold").select("x", "y") if len(sides) > 1 else labelled.select("x", "y")
    labelled = labelled.filter("not fold").select("x", "y") if len(sides) > 1 else apart
    sums = _summed(labelled, lambda x, y: np.concatenate(([len(x)], x.sum(0), (x * x).sum(0))))
    if sums is None:
        return Model(np.zeros(d), np.ones(d))
    n = sums[0]
    mean = sums[1 : d + 1] / n
    model = Model(mean, np.sqrt(np.maximum(sums[d + 1 :] / n - mean**2, 0)))
    upper = np.triu_indices(FEATURES + d + 1)

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = model.features(x)
        return np.concatenate(((f.T @ f)[upper], f.T @ y))

    both = _summed(labelled, equations)
    k = FEATURES + d + 1
    left = np.zeros((k, k))
    left[upper] = both[: len(upper[0])]
    left = left + np.triu(left, 1).T
    model.weights = np.linalg.solve(left + RIDGE * n / k * np.eye(k), both[len(upper[0]) :])

    def by_bin(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        s = model.raw(x)
        at = np.clip(((s - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, w, BINS) for w in (np.ones(len(x)), y, s)])

    counts, ys, ss = _summed(apart, by_bin).reshape(3, BINS)
    full = counts > 0
    model.knots, model.values = isotonic(ss[full] / counts[full], ys[full], counts[full])
    return model


def score_quality(docs: DataFrame, labels: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(id, held_out, score)`` for each row of ``docs``: the calibrated probability of label 1.

    Statistics of each whole text are written once; rows that have a label and aren't held out (null counts
    as not) train. Labels meet documents by id; of several labels for an id the mean counts, null labels
    and null ids train nothing. Null, empty and blank texts have all statistics zero and get a score too.
    Without any training row every score is 0.5. Repeated rows are scored (and train) each.
    Only sums, whose size depends on the number of features, reach the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column(2).to_pylist()], np.float64).reshape(-1)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], names=["id", "held", "x"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).cast("string").alias("text"))
    known = materialise(rows.mapInArrow(describe, f"id {kind}, held boolean, x array<double>"), "quality-statistics")
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).filter("id is not null and y is not null")
    marks = marks.groupBy("id").agg(F.avg("y").alias("y"))
    labelled = known.filter(~F.col("held")).join(marks, "id").select("x", "y", (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("fold"))
    labelled = materialise(labelled, "quality-labelled")
    model = spark.sparkContext.broadcast(fit(labelled))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.value.probability(_arrays(batch, 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.clip(p, 0, 1))], names=["id", "held_out", "score"])

    return known.mapInArrow(score, f"id {kind}, held_out boolean, score double").withColumnRenamed("id", id_col)
