"""Benchmark decontamination: BM25 over test items by block-max WAND, then overlap of question and answer."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import materialise, number_of, numbered_columns, own_columns, small_batches

TOKEN = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
#: Words of a training passage, and from one passage to the next.
PASSAGE, STRIDE = 64, 32
#: Words of an indexed part of an item: longer items are cut, so that a passage can hold a part.
PART = 32
#: Share of an item part's own BM25 score that a passage has to reach.
THRESHOLD = 0.6
#: Shingle length and share for questions; share of words for answers.
SHINGLE, QUESTION_OVERLAP, ANSWER_OVERLAP = 5, 0.8, 0.8
K1, B = 1.2, 0.75
#: Postings in a block of an inverted list; the bound for whole texts has blocks of this many parts or more, COLUMNS blocks at most.
POSTINGS, PARTS, COLUMNS = 64, 4, 128
#: Numbers in the table of that bound: an index of many terms has fewer and longer blocks, which prune less and lose nothing.
BOUND_ENTRIES = 8_000_000
#: Items and bytes of one broadcast index: a larger benchmark takes several, each against all documents.
INDEX_ITEMS, INDEX_BYTES = 20_000, 8_000_000


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's last sentence is its answer, what comes before its question; of a single sentence, the last quarter of the words."""
    parts = [p for p in map(tokens, SENTENCE.split(text)) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 4
    return words[:cut], words[cut:]


def share_of_shingles(part: list[str], region: list[str], n: int = SHINGLE) -> float:
    """The share of ``part``'s n-word shingles (all of it if shorter) that ``region`` has."""
    n = min(n, len(part))
    if not n:
        return 1.0
    there = {tuple(region[i : i + n]) for i in range(len(region) - n + 1)}
    own = [tuple(part[i : i + n]) for i in range(len(part) - n + 1)]
    return sum(s in there for s in own) / len(own)


def share_of_words(part: list[str], region: list[str]) -> float:
    if not part:
        return 1.0
    return sum((Counter(part) & Counter(region)).values()) / len(part)


class Index:
    """Inverted lists of item parts with BM25 impacts as shares of each part's own score, cut in blocks with their maxima."""

    def __init__(self, items: list[tuple[object, str]], df: dict[str, int], n_items: int, mean_words: float) -> None:
        self.items = [(key, *question_and_answer(text)) for key, text in items]
        lists: dict[str, list[tuple[int, float]]] = {}
        self.owner: list[int] = []
        for k, (_, question, answer) in enumerate(self.items):
            words = question + answer
            count = max(1, -(-len(words) // PART))
            for c in range(count):
                counts = Counter(words[len(words) * c // count : len(words) * (c + 1) // count])
                length = sum(counts.values())
                norm = K1 * (1 - B + B * length / max(mean_words, 1e-9))
                weights = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in counts.items()}
                total = sum(weights.values())
                if total > 0:
                    for w, x in weights.items():
                        lists.setdefault(w, []).append((len(self.owner), x / total))
                    self.owner.append(k)
        self.terms = {w: i for i, w in enumerate(lists)}
        self.docs = [[d for d, _ in p] for p in lists.values()]
        self.impacts = [[x for _, x in p] for p in lists.values()]
        self.most = [max(x) for x in self.impacts]
        self.last = [[d[min(i + POSTINGS, len(d)) - 1] for i in range(0, len(d), POSTINGS)] for d in self.docs]
        self.block_most = [[max(x[i : i + POSTINGS]) for i in range(0, len(x), POSTINGS)] for x in self.impacts]
        # For the bound over whole texts: row of a term, column of a block of parts; the last row is for unknown words.
        columns = max(1, min(COLUMNS, BOUND_ENTRIES // (len(lists) + 1)))
        size = max(PARTS, -(-len(self.owner) // columns))
        self.bound = np.zeros((len(lists) + 1, -(-len(self.owner) // size) or 1), np.float32)
        for t, (d, x) in enumerate(zip(self.docs, self.impacts, strict=True)):
            np.maximum.at(self.bound[t], np.array(d) // size, np.array(x, np.float32))

    def passages(self, words: list[str]) -> Iterator[int]:
        """Starts of passages in which some block of parts may reach the threshold.

        The bound of a passage and a block is the sum of block maxima over the passage's distinct words. It is added
        up from two halves: of a half that begins the passage each word's first place counts, of one that
        ends it only words that the half before doesn't have.
        """
        unknown = len(self.docs)
        ids = np.fromiter((self.terms.get(w, unknown) for w in words), np.int64, len(words))
        step = 512 * STRIDE
        for at in range(0, max(1, len(words) - STRIDE), step):
            own = ids[at : at + step + STRIDE]
            halves = -(-len(own) // STRIDE)
            place = np.flatnonzero(own != unknown)
            if not len(place):
                continue
            known = own[place]
            order = np.argsort(known, kind="stable")
            before = np.full(len(known), -1)
            same = known[order[1:]] == known[order[:-1]]
            before[order[1:][same]] = place[order[:-1][same]]
            half = place // STRIDE
            rows = self.bound[known]
            begin = self._by_half(rows, half, before < half * STRIDE, halves)
            end = self._by_half(rows, half, before < (half - 1) * STRIDE, halves)
            sums = begin.copy()
            sums[:-1] += end[1:]
            last = max(1, halves - 1)
            for k in np.flatnonzero(sums[:last].max(axis=1) >= THRESHOLD - 1e-4).tolist():
                yield at + k * STRIDE

    @staticmethod
    def _by_half(rows: np.ndarray, half: np.ndarray, counted: np.ndarray, halves: int) -> np.ndarray:
        out = np.zeros((halves, rows.shape[1]), np.float32)
        rows, half = rows[counted], half[counted]
        if len(half):
            starts = np.flatnonzero(np.r_[True, half[1:] != half[:-1]])
            out[half[starts]] = np.add.reduceat(rows, starts, axis=0)
        return out

    def search(self, words: set[str], threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All parts that score at least ``threshold`` for a passage, by block-max WAND over documents at a time."""
        found = []
        cursors = [[self.docs[t][0], t, 0] for t in (self.terms.get(w) for w in words) if t is not None]
        slack = threshold - 1e-9
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, (_, t, _) in enumerate(cursors):
                total += self.most[t]
                if total >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            bound, end = 0.0, None
            for d, t, _ in cursors[: pivot + 1]:
                b = bisect_left(self.last[t], doc)
                if b < len(self.last[t]):
                    bound += self.block_most[t][b]
                    end = self.last[t][b] if end is None else min(end, self.last[t][b])
            if bound < slack:
                # No part up to the nearest block end, or the next list's part, can reach the threshold.
                to = (end if end is not None else doc) + 1
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, doc + 1) if cursors[0][0] == doc else max(to, doc)
                cursors = self._forward(cursors, pivot, to)
            elif cursors[0][0] == doc:
                score = sum(self.impacts[t][p] for _, t, p in cursors[: pivot + 1])
                if score >= slack:
                    found.append((doc, score))
                cursors = self._forward(cursors, pivot, doc + 1)
            else:
                cursors = self._forward(cursors, pivot, doc)
        return found

    def _forward(self, cursors: list[list[int]], pivot: int, to: int) -> list[list[int]]:
        """Moves the cursors up to the pivot to the first posting at ``to`` or beyond; ended lists go."""
        out = []
        for k, (d, t, p) in enumerate(cursors):
            if k <= pivot and d < to:
                p = bisect_left(self.docs[t], to, p)
                if p == len(self.docs[t]):
                    continue
                d = self.docs[t][p]
            out.append([d, t, p])
        return out

    def leaks(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Item number to ``(score, question overlap, answer overlap)`` for the items that the text has."""
        words = tokens(text)
        out: dict[int, tuple[float, float, float]] = {}
        for start in self.passages(words) if words and self.owner else ():
            for part, score in self.search(set(words[start : start + PASSAGE])):
                k = self.owner[part]
                _, question, answer = self.items[k]
                length = len(question) + len(answer)
                region = words[max(0, start - length) : start + PASSAGE + length]
                q, a = share_of_shingles(question, region), share_of_words(answer, region)
                if q >= QUESTION_OVERLAP and a >= ANSWER_OVERLAP:
                    out[k] = max(out.get(k, (0.0, 0.0, 0.0)), (score, q, a))
        return out


def _indexes(items: DataFrame, item_id: str, item_text: str) -> Iterator[Index]:
    """Indexes of bounded size; document frequencies and mean length are those of the whole benchmark."""
    small_batches(items.sparkSession)
    known = items.select(F.col(item_id).alias("key"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    size = known.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not size[0]:
        return
    blocks = max(1, -(-size[0] // INDEX_ITEMS), -(-(size[1] or 0) // INDEX_BYTES))
    known = known.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                all_words = tokens(text)
                own = list(set(all_words)) or [""]
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array([block] * len(own), pa.int64()), pa.array([len(all_words)] + [0] * (len(own) - 1), pa.int64())], names=["word", "block", "n"])

    table = materialise(known.select("text", "block").mapInArrow(words, "word string, block long, n long"), "item-words")
    mean = table.agg(F.sum("n")).first()[0] / size[0]
    df = materialise(table.groupBy("word").agg(F.count("*").alias("df")), "item-df")
    for b in range(blocks):
        own = table.filter(F.col("block") == b).select("word").distinct().join(df, "word").collect()
        rows = known.filter(F.col("block") == b).select("key", "text").collect()
        index = Index(sorted((tuple(r) for r in rows), key=str), dict(tuple(r) for r in own), size[0], mean)
        index.of = blocks
        yield index


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(id, item, score, question_overlap, answer_overlap)``: the benchmark items that each document contains.

    Every passage (64 words, a half apart, over the whole text) queries a BM25 index of item parts;
    block-max WAND retrieves all parts that reach a fixed share of their own score. A hit counts if the
    words around it have 0.8 of the question's five-word shingles and of the answer's words. Scores are the best
    passage's. Null and empty texts and items have no hit; an item shorter than a shingle has to occur as it
    is. Repeated documents give their rows again; items with equal texts all count. The index is
    broadcast in parts of bounded size, each against all documents, which are never shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"id {id_kind}, item {item_kind}, score double, question_overlap double, answer_overlap double"
    out = spark.createDataFrame([], schema)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    for index in _indexes(items, item_id, item_text):
        shared = spark.sparkContext.broadcast(index)
        keys = pa.array([k for k, _, _ in index.items])

        def run(batches: Iterator[pa.RecordBatch], shared=shared, keys=keys) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                at, item, rest = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for k, scores in sorted(index.leaks(text).items()):
                        at.append(i)
                        item.append(k)
                        rest.append(scores)
                columns = [batch.column(0).take(pa.array(at, pa.int64())), keys.take(pa.array(item, pa.int64()))]
                columns += [pa.array([r[j] for r in rest], pa.float64()) for j in range(3)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "item", "score", "question_overlap", "answer_overlap"])

        part = texts.mapInArrow(run, schema)
        if index.of > 1:
            # One index at a time is held by the driver and the workers.
            part = materialise(part, "leaks")
            shared.destroy()
        out = out.union(part)
    return out


def remove_leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item; rows are told apart by id and text hash."""
    bare = numbered_columns(docs)
    own_id, own_text = number_of(docs, id_col), number_of(docs, text_col)
    marked = bare.withColumn("mark", F.xxhash64(F.col(own_text).cast("string")))
    keyed = marked.select(F.struct(F.col(own_id).alias("id"), "mark").alias("key"), F.col(own_text).alias("body"))
    found = materialise(find_leaks(keyed, items, "key", "body", **columns).select(F.col("id.id").alias("leaked"), F.col("id.mark").alias("hash")).distinct(), "leaked")
    return marked.join(found, F.col(own_id).eqNullSafe(F.col("leaked")) & (F.col("mark") == F.col("hash")), "left_anti").select(*own_columns(docs))
