"""Names in texts: which of a table of names, however large, stand in each text."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.plans.shared import small_batches

#: Least and most bits of the table of name hashes that workers hold (64 MB), and bits for each name within these limits.
LEAST_BITS, MOST_BITS, BITS_A_NAME = 1 << 23, 1 << 29, 32
#: Characters whose windows are hashed at a time.
SLICE_CHARS = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and how many of its text's stand from each on."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    return codes, np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))


class Windows:
    """Hashes of all windows of any length over texts: differences of running sums, turned back to the window's place."""

    def __init__(self, texts: list[str]) -> None:
        codes, self.left = _codes(texts)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * _powers(_BASE, len(codes)))))
        self.back = _powers(pow(_BASE, -1, 1 << 64), len(codes))

    def hashes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which a window of ``n`` characters fits its text, and their hashes."""
        at = np.flatnonzero(self.left >= n)
        return at, (self.sums[at + n] - self.sums[at]) * self.back[at]


#: Odd factors: each gives a hash its own position in the table.
_FACTORS = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)


def positions(hashes: np.ndarray, factor: int, bits: int) -> np.ndarray:
    h = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(29))) & np.uint64(bits - 1)).astype(np.int64)


def table_bits(n: int) -> int:
    """Bits of the table for ``n`` names, a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_NAME * n - 1).bit_length()))


def position(name: Column, bits: int) -> Column:
    """The two table positions of a whole name."""

    @F.pandas_udf("array<long>")
    def hashed(names: pd.Series) -> pd.Series:
        texts = names.tolist()
        windows, sizes = Windows(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.cumsum(sizes) - sizes
        whole = (windows.sums[at + sizes] - windows.sums[at]) * windows.back[at]
        return pd.Series(list(np.stack([positions(whole, f, bits) for f in _FACTORS], axis=1)))

    return hashed(name)


def finder(names: DataFrame, name_col: str = "name") -> Callable[[Column], Column]:
    """A column function from a text to those of its substrings that may be among ``names``, each once; all that are, are there.

    Workers hold the lengths of the names and two bits for each hash: a window whose bits are set passes (few do, as the table grows
    with the names to 64 MB; what passes by chance would fill the workers), so a join of the
    result with the names by equality drops what passes by chance. The names themselves are never sent; whether they
    are ten or a billion, the plan is the same.
    """
    names = names.select(F.col(name_col).alias("name")).filter("name <> ''")
    lengths = sorted(r[0] for r in names.select(F.char_length("name").alias("n")).distinct().collect())
    bits = table_bits(names.count())
    at = names.select(F.explode(position(F.col("name"), bits)).alias("at")).select((F.col("at") + 1).alias("at"))
    table = np.zeros(bits // 8, np.uint8)
    for bucket, set_ in at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toLocalIterator():
        part = np.frombuffer(bytes(set_), np.uint8)
        table[(bucket - 1) * len(part) : bucket * len(part)] = part
    held = names.sparkSession.sparkContext.broadcast((lengths, table))
    small_batches(names.sparkSession)

    def hits(rows: list[str]) -> list[list[str]]:
        sizes, table = held.value
        whole, starts = "".join(rows), np.cumsum([0, *map(len, rows)])
        windows, out = Windows(rows), [set() for _ in rows]
        for n in sizes:
            place, h = windows.hashes(n)
            for factor in _FACTORS:
                p = positions(h, factor, bits)
                passed = (table[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
                place, h = place[passed], h[passed]
            for p, row in zip(place.tolist(), (np.searchsorted(starts, place, "right") - 1).tolist(), strict=True):
                out[row].add(whole[p : p + n])
        return [sorted(h) for h in out]

    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        rows, out, at = texts.fillna("").tolist(), [], 0
        while at < len(rows):
            to, size = at, 0
            while to < len(rows) and (to == at or size + len(rows[to]) <= SLICE_CHARS):
                size += len(rows[to])
                to += 1
            out += hits(rows[at:to])
            at = to
        return pd.Series(out)

    return found
