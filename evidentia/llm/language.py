"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise, small_batches

#: Units of each direction, and bytes of one segment: states begin anew in each.
UNITS, SEGMENT = 12, 96
#: Segments of each language that train the network at most: the bound of the sample.
SAMPLE = 2000
#: Copies of the network that are trained side by side and averaged after each round; segments of one step.
COPIES, ROUNDS, STEP, RATE, SEED = 4, 6, 128, 0.02, 11
#: Segments that go through the network together.
LANES = 2048


class Direction:
    """One gated recurrent layer: each step takes a byte and the state ``h`` (units by lanes).

    ``z, r = s(E[byte] + U h)``, ``n = tanh(E[byte] + r * U h)``, ``h = n + z (h - n)``, where ``s(v) = (1 + tanh v) / 2``.
    Lanes are in order of falling length, so those that have a byte at a place are the first ones.
    """

    def __init__(self, embed: np.ndarray, recur: np.ndarray, backward: bool) -> None:
        self.embed, self.recur, self.backward = embed, recur, backward

    def places(self, length: int) -> range:
        return range(length - 1, -1, -1) if self.backward else range(length)

    def run(self, x: np.ndarray, active: np.ndarray, seen, trace: list | None = None) -> None:
        """Calls ``seen(place, states)`` at each place; what a later gradient needs goes to ``trace``."""
        k = len(self.recur) // 3
        h = np.zeros((k, x.shape[1]), np.float32)
        for t in self.places(len(x)):
            n_t = active[t]
            if n_t == 0:
                continue
            before = h[:, :n_t]
            g = np.take(self.embed, x[t, :n_t], axis=1, mode="clip")
            a = self.recur @ before
            zr = g[: 2 * k]
            zr += a[: 2 * k]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            new = g[2 * k :]
            if trace is None:
                a[2 * k :] *= zr[k:]
                new += a[2 * k :]
            else:
                new += a[2 * k :] * zr[k:]
            np.tanh(new, out=new)
            if trace is not None:
                trace.append((t, before.copy(), zr, new, a[2 * k :]))
            before -= new
            before *= zr[:k]
            before += new
            seen(t, before)

    def gradient(self, x: np.ndarray, trace: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time: gradients of ``embed`` and ``recur``, given those of the states at each place."""
        k = len(self.recur) // 3
        d_embed, d_recur = np.zeros_like(self.embed), np.zeros_like(self.recur)
        dh = np.zeros(d_states.shape[1:], np.float32)
        for t, before, zr, new, inner in reversed(trace):
            n_t = new.shape[1]
            z, r = zr[:k], zr[k:]
            d = dh[:, :n_t] + d_states[t, :, :n_t]
            d_new = d * (1 - z) * (1 - new * new)
            d_gates = np.vstack((d * (before - new) * 2 * z * (1 - z), d_new * inner * 2 * r * (1 - r)))
            d_inner = np.vstack((d_gates, d_new * r))
            d_recur += d_inner @ before.T
            cell = np.arange(3 * k)[:, None] * 256 + x[t, :n_t]
            d_embed += np.bincount(cell.ravel(), np.vstack((d_gates, d_new)).ravel(), 3 * k * 256).reshape(3 * k, 256)
            dh[:, :n_t] = d * z + self.recur.T @ d_inner
        return d_embed, d_recur


class Network:
    """Both directions, and a label for every position from the two states there."""

    def __init__(self, weights: list[np.ndarray]) -> None:
        self.weights = weights
        self.forth, self.back = Direction(weights[0], weights[1], False), Direction(weights[2], weights[3], True)
        self.out_forth, self.out_back, self.bias = weights[4:]

    @classmethod
    def fresh(cls, classes: int, units: int = UNITS) -> Network:
        rng = np.random.default_rng(SEED)
        shapes = [(3 * units, 256), (3 * units, units)] * 2 + [(classes, units)] * 2 + [(classes, 1)]
        scales = [0.5, 1 / np.sqrt(units)] * 2 + [0.1, 0.1, 0.0]
        return cls([rng.normal(0, s, shape).astype(np.float32) for shape, s in zip(shapes, scales, strict=True)])

    def pooled(self, x: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Sums over each lane's positions of the label probabilities (classes by lanes)."""
        scores = np.empty((len(x), len(self.bias), x.shape[1]), np.float32)
        total = np.zeros(scores.shape[1:], np.float32)

        def first(t: int, h: np.ndarray) -> None:
            np.matmul(self.out_forth, h, out=scores[t, :, : h.shape[1]])

        def second(t: int, h: np.ndarray) -> None:
            p = self.out_back @ h
            p += scores[t, :, : h.shape[1]]
            p += self.bias
            np.exp(np.clip(p, -60, 60, out=p), out=p)
            p /= p.sum(0)
            total[:, : h.shape[1]] += p

        self.forth.run(x, active, first)
        self.back.run(x, active, second)
        return total

    def learn(self, x: np.ndarray, active: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy over all positions."""
        units = self.recur_units()
        states = [np.zeros((len(x), units, x.shape[1]), np.float32) for _ in range(2)]
        traces: list[list] = [[], []]
        for way, kept, trace in zip((self.forth, self.back), states, traces, strict=True):
            way.run(x, active, lambda t, h, kept=kept: kept.__setitem__((t, slice(None), slice(h.shape[1])), h), trace)
        p = np.einsum("ck,tkb->tcb", self.out_forth, states[0]) + np.einsum("ck,tkb->tcb", self.out_back, states[1]) + self.bias
        p = np.exp(p - p.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[:, label, np.arange(x.shape[1])] -= 1
        p *= (np.arange(x.shape[1]) < active[:, None])[:, None, :] / np.float32(active.sum())
        grads = []
        for way, out, trace in zip((self.forth, self.back), (self.out_forth, self.out_back), traces, strict=True):
            grads += way.gradient(x, trace, np.einsum("ck,tcb->tkb", out, p))
        return [*grads, np.einsum("tcb,tkb->ck", p, states[0]), np.einsum("tcb,tkb->ck", p, states[1]), p.sum((0, 2))[:, None]]

    def recur_units(self) -> int:
        return self.forth.recur.shape[1]


def segments(lengths: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of so many bytes at these places, cut into nearly equal segments: text number, place and bytes of each."""
    parts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(lengths)), parts)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin, end = lengths[owner] * k // parts[owner], lengths[owner] * (k + 1) // parts[owner]
    return owner, starts[owner] + begin, end - begin


def lanes(data: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of segments (in order of falling size) by position and lane, and how many lanes have each position."""
    positions = np.arange(size[0])
    x = data[np.minimum(place + positions[:, None], len(data) - 1)].astype(np.intp)
    return x, np.searchsorted(-size, -positions, side="left")


def probabilities(network: Network, texts: pa.Array) -> np.ndarray:
    """Mean label probabilities over all bytes of each text (texts by classes); zeros for null and empty ones."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    owner, place, size = segments(lengths, offsets[:-1])
    order = np.argsort(-size, kind="stable")
    found = np.zeros((len(texts), len(network.bias)))
    for at in range(0, len(order), LANES):
        rows = order[at : at + LANES]
        x, active = lanes(data, place[rows], size[rows])
        sums = network.pooled(x, active)
        for c in range(found.shape[1]):
            found[:, c] += np.bincount(owner[rows], sums[c], len(texts))
    return found / np.maximum(lengths, 1)[:, None]


def train(weights: list[np.ndarray], data: list[bytes], label: np.ndarray, seed: int, rate: float) -> list[np.ndarray]:
    """One round over the segments in steps of STEP, by Adam."""
    weights = [w.copy() for w in weights]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    order = np.random.default_rng(seed).permutation(len(data))
    for step, at in enumerate(range(0, len(order), STEP), 1):
        rows = sorted(order[at : at + STEP], key=lambda i: -len(data[i]))
        size = np.array([len(data[i]) for i in rows])
        x, active = lanes(np.frombuffer(b"".join(data[i] for i in rows), np.uint8), np.cumsum(size) - size, size)
        for w, g, m, v in zip(weights, Network(weights).learn(x, active, label[rows]), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return weights


def sample_segments(known: DataFrame) -> DataFrame:
    """At most SAMPLE distinct segments of each language, those of least hash, as rows ``(lang, copy, hash, bytes)``; written.

    Segments of all labelled texts take part. The number of a language's segments tells how small a hash has to be, so
    that not much more than the sample is ever gathered.
    """
    size = F.octet_length("text")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.sum(F.ceil(size / SEGMENT)).alias("n")).collect()}
    below = {lang: min(2**64 - 1, int(2**64 * 1.5 * SAMPLE / max(1, n))) for lang, n in counts.items()}

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, bytes]] = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data, least = text.encode(), below[lang]
                parts = -(-len(data) // SEGMENT)
                for k in range(parts):
                    piece = data[len(data) * k // parts : len(data) * (k + 1) // parts]
                    if (h := xxhash.xxh64_intdigest(piece)) <= least:
                        out.append((lang, h - 2**63, piece))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["lang", "hash", "bytes"])

    found = known.select("lang", "text").mapInArrow(chosen, "lang string, hash long, bytes binary").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "bytes"))
    return materialise(found.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE).select("lang", (F.col("rank") % COPIES).alias("copy"), "hash", "bytes"), "language-sample")


def fit(known: DataFrame) -> tuple[list[str], Network | None]:
    """Languages of the labelled rows ``(lang, text)`` and the network that tells them apart.

    Copies of the network train side by side in tasks, each on its part of the sample, and are averaged after each
    round; the driver sees their weights only.
    """
    sample = sample_segments(known)
    names = sorted(r.lang for r in sample.select("lang").distinct().collect())
    if not names:
        discard(sample)
        return [], None
    network = Network.fresh(len(names))
    shapes = [w.shape for w in network.weights]
    split = np.cumsum([w.size for w in network.weights])[:-1]

    def trained(now: list[np.ndarray], turn: int):
        def one(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["lang", "hash"])
            label = np.array([names.index(x) for x in rows["lang"]])
            weights = train(now, [bytes(b) for b in rows["bytes"]], label, turn, RATE * (1 - turn / ROUNDS))
            return pd.DataFrame({"n": [len(rows)], "weights": [np.concatenate([w.ravel() for w in weights]).astype(float)]})

        return one

    for turn in range(ROUNDS):
        found = sample.groupBy("copy").applyInPandas(trained(network.weights, turn), "n long, weights array<double>").collect()
        mean = sum(r.n * np.array(r.weights) for r in sorted(found, key=lambda r: (r.n, r.weights))) / sum(r.n for r in found)
        network = Network([w.reshape(s).astype(np.float32) for w, s in zip(np.split(mean, split), shapes, strict=True)])
    discard(sample)
    return names, network


def identify(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` for each row: the language that the bytes of its whole text speak for.

    A bidirectional gated recurrent network reads each text's bytes in segments, labels every position, and the mean of
    the labels' probabilities over all positions is the text's. It is trained by backpropagation through time on
    at most SAMPLE segments of each language, from rows that aren't held out (null counts as not) and have a text and a language.

    Text that is null or has no letter is ``und`` with score 0, as is everything if no row teaches a language. Ties go to
    the first language by name. Repeated rows are each predicted; in the sample equal segments count once. A row's own language, id and
    other columns play no part in its prediction.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    names, network = fit(rows.filter("not held and lang is not null and text <> ''").select("lang", "text"))
    readable = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    held = spark.sparkContext.broadcast(network.weights if network else None)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = pa.array(["und"] * len(batch)), np.zeros(len(batch))
            if held.value is not None and len(batch):
                p = probabilities(Network(held.value), batch.column(2))
                spoken = p.sum(1) > 0
                pred = pa.array(np.where(spoken, np.array(names, object)[p.argmax(1)], "und"), pa.string())
                score = np.where(spoken, np.clip(p.max(1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pred, pa.array(score, pa.float64())], names=["id", "held_out", "lang_pred", "score"])

    found = rows.select("id", "held", readable.alias("text")).mapInArrow(predict, f"id {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)
