"""Han words: a dictionary learned from texts and names, and the cheapest path through its words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions import text as T
from evidentia.plans.shared import delete, small_batches, written

#: Words of a dictionary: the bound of what is sent to workers. The most frequent ones stay.
DICTIONARY_WORDS = 500_000
#: The unit of costs: ln(total / frequency) in millionths, so that sums are whole numbers and ties are ties.
COST = 1_000_000
#: Characters whose paths are sought at a time: arrays over them are some hundred bytes a character.
SLICE_CHARS = 1 << 18
_HAN_PART = re.compile(f"({T.HAN}+)")
_NONE = np.int64(1) << 60


class Trie:
    """A prefix dictionary in sorted arrays: ``(node, character)`` leads to a node, which may end a word of some cost."""

    def __init__(self, words: Iterable[tuple[str, int]], single: int) -> None:
        """``words`` with their costs; ``single`` is the cost of a character that is no word."""
        self.single = single
        nodes: dict[tuple[int, str], int] = {}
        cost = [_NONE]
        for word, price in words:
            at = 0
            for c in word:
                at = nodes.setdefault((at, c), len(cost))
                if at == len(cost):
                    cost.append(_NONE)
            cost[at] = min(cost[at], np.int64(price))
        keys = np.fromiter(((a << 21) | ord(c) for a, c in nodes), np.int64, len(nodes))
        order = np.argsort(keys)
        self.keys, self.to, self.cost = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order], np.array(cost)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The node that each character leads to; -1 where the dictionary ends."""
        key = (node << 21) | char
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return np.where((node >= 0) & (self.keys[at] == key), self.to[at], -1) if len(self.keys) else np.full(len(node), -1)

    def ending(self, chars: np.ndarray, left: np.ndarray) -> list[np.ndarray]:
        """For lengths 1, 2, ...: the cost of the word of that length at each place, of which ``left`` places belong to its run."""
        found, node, length = [], np.zeros(len(chars), np.int64), 0
        while (alive := np.flatnonzero((node >= 0) & (left > length))).size:
            now = np.full(len(chars), -1)
            now[alive] = self.step(node[alive], chars[alive + length])
            found.append(np.where(now >= 0, self.cost[now], _NONE))
            node, length = now, length + 1
        if found:
            found[0] = np.where(found[0] < _NONE, found[0], self.single)
        return found

    def segment(self, runs: list[str]) -> list[list[str]]:
        """Tokens of each run: the words of its cheapest path, each after the shorter words inside it (of two, then of three characters).

        All runs go through together, from their ends: at each place the cheapest word and the cheapest path after it; of equals the longest.
        """
        size = np.fromiter(map(len, runs), np.int64, len(runs))
        chars = np.frombuffer("".join(runs).encode("utf-32-le"), np.uint32).astype(np.int64)
        begin = np.cumsum(size) - size
        left = np.repeat(begin + size, size) - np.arange(len(chars))
        costs = self.ending(chars, left)
        best = np.zeros(len(chars) + 1, np.int64)
        take = np.ones(len(chars), np.int64)
        order = np.argsort(left, kind="stable")
        edges = np.searchsorted(left[order], np.arange(1, (size.max() if len(size) else 0) + 2))
        for a, z in zip(edges, edges[1:], strict=False):
            at = order[a:z]
            choice, length = np.full(len(at), _NONE), np.ones(len(at), np.int64)
            for n, cost in enumerate(costs, 1):
                fits = left[at] >= n
                total = np.where(fits, cost[at] + np.where(left[at] > n, best[np.minimum(at + n, len(chars))], 0), _NONE)
                better = total <= np.minimum(choice, _NONE - 1)
                choice, length = np.where(better, total, choice), np.where(better, n, length)
            best[at], take[at] = choice, length
        out = []
        for run, first in zip(runs, begin, strict=True):
            tokens, k = [], 0
            while k < len(run):
                n = int(take[first + k])
                for short in (2, 3):
                    if n > short:
                        tokens += [run[i : i + short] for i in range(k, k + n - short + 1) if costs[short - 1][first + i] < _NONE]
                tokens.append(run[k : k + n])
                k += n
            out.append(tokens)
        return out


def learn_dictionary(texts: DataFrame, names: DataFrame, text_col: str = "text", name_col: str = "name", longest: int = 4, least: int = 5, cohesion: int = 4) -> DataFrame:
    """``(word, freq)``: Han words learned from texts, and the Han names of a table.

    A run of 2 to ``longest`` Han characters is a word if it occurs ``least`` times and, at each of its cuts, ``cohesion`` times as
    often as its two parts would meet by chance; a character that occurs ``least`` times is one, too. A name of two characters or more is a
    word whatever its count; its frequency is its count, at least ``least``. Counts are combined before the shuffle.
    """
    runs = texts.select(F.explode(F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(f"({T.HAN}+)"), F.lit(1))).alias("run"))
    n = F.char_length("run")
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.least(n, F.lit(longest))), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col("run"), i, k))))
    counted = written(runs.groupBy("run").agg(F.count("*").alias("times")).select(F.explode(pieces).alias("word"), "times").groupBy("word").agg(F.sum("times").alias("freq")).filter(F.col("freq") >= least), "han-counts")
    total = counted.filter(F.char_length("word") == 1).agg(F.coalesce(F.sum("freq"), F.lit(0))).first()[0]
    size = F.char_length("word")
    cuts = counted.filter(size > 1).select("word", "freq", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"), size.alias("size"))
    cuts = cuts.select("word", "freq", F.substring(F.col("word"), F.lit(1), F.col("k")).alias("head"), F.substring(F.col("word"), F.col("k") + 1, F.col("size")).alias("rest"))
    met = cuts.join(counted.select(F.col("word").alias("head"), F.col("freq").alias("a")), "head").join(counted.select(F.col("word").alias("rest"), F.col("freq").alias("b")), "rest")
    holds = F.col("freq").cast("decimal(38,0)") * total >= F.col("a").cast("decimal(18,0)") * F.col("b").cast("decimal(18,0)") * cohesion
    words = met.groupBy("word").agg(F.first("freq").alias("freq"), F.bool_and(holds).alias("holds")).filter("holds").select("word", "freq")
    words = words.union(counted.filter(size == 1).select("word", "freq"))
    named = names.select(F.explode(F.regexp_extract_all(F.coalesce(name_col, F.lit("")), F.lit(f"({T.HAN}{{2,}})"), F.lit(1))).alias("word")).distinct()
    named = named.join(counted, "word", "left").select("word", F.coalesce("freq", F.lit(least)).alias("freq"))
    out = written(words.union(named).groupBy("word").agg(F.max("freq").alias("freq")), "han-dictionary")
    delete(counted)
    return out


def priced(dictionary: DataFrame) -> tuple[list[tuple[str, int]], int]:
    """The words of ``(word, freq)`` with their costs, and the cost of a character that is no word: that of frequency one."""
    bounded = dictionary.orderBy(F.desc("freq"), F.asc("word")).limit(DICTIONARY_WORDS)
    total = F.lit(bounded.agg(F.coalesce(F.sum("freq"), F.lit(1))).first()[0])
    cost = lambda freq: F.round(F.log(total / freq) * COST).cast("long")
    return [tuple(r) for r in bounded.select("word", cost(F.col("freq"))).collect()], dictionary.sparkSession.range(1).select(cost(F.lit(1))).first()[0]


@lru_cache(maxsize=4)
def _trie(held: Broadcast) -> Trie:
    return Trie(*held.value)


def _slices(runs: list[str], chars: int) -> Iterator[list[str]]:
    """Runs in order, in parts of at most ``chars`` characters, or one longer run."""
    part, size = [], 0
    for run in runs:
        if part and size + len(run) > chars:
            yield part
            part, size = [], 0
        part.append(run)
        size += len(run)
    if part:
        yield part


def segmenter(dictionary: DataFrame) -> Callable[[Column], Column]:
    """A column function like ``text.tokens`` that cuts Han parts of its runs into words of ``(word, freq)``.

    At most DICTIONARY_WORDS words, the most frequent ones, are sent to workers, each of which builds its trie once. What stands between Han parts
    of a run is a token of its own. No unseen words are guessed: their characters stand alone.
    """
    held = dictionary.sparkSession.sparkContext.broadcast(priced(dictionary))
    small_batches(dictionary.sparkSession)

    @F.pandas_udf("array<string>")
    def cut(runs: pd.Series) -> pd.Series:
        parts = [[p for run in row for p in _HAN_PART.split(run) if p] for row in runs]
        han, known = sorted({p for row in parts for p in row if _HAN_PART.fullmatch(p)}), {}
        for some in _slices(han, SLICE_CHARS):
            known |= zip(some, _trie(held).segment(some), strict=True)
        return pd.Series([[t for p in row for t in known.get(p, (p,))] for row in parts])

    def tokens(text: Column) -> Column:
        runs = T.tokens(text)
        return F.when(text.rlike(T.HAN), cut(F.when(text.rlike(T.HAN), runs).otherwise(F.array().cast("array<string>")))).otherwise(runs)

    return tokens
