"""Packing of token pieces into full training sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import materialise, small_batches
from evidentia.llm.tokens import ByteEncoder

#: Pieces of one length and bucket that a window numbers together, about.
BUCKET_ROWS = 1_000


def fullest_bin(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many pieces of each length to put in one bin: the longest piece left, and of the rest the set that leaves least slack.

    Subset sums are bits of an integer: bit s says that some chosen pieces fill s. Each length is tried
    as often as it is there and fits; the bits before each try lead back from the best sum to its pieces.
    """
    lengths = sorted(counts, reverse=True)
    largest = lengths[0]
    room = capacity - largest
    full = (1 << (room + 1)) - 1
    reach, tries = 1, []
    for n in lengths:
        for _ in range(min(counts[n] - (n == largest), room // n if n <= room else 0)):
            grown = (reach | reach << n) & full
            if grown == reach:
                break
            tries.append((n, reach))
            reach = grown
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    chosen = {largest: 1}
    for n, before in reversed(tries):
        if not before >> at & 1:
            chosen[n] = chosen.get(n, 0) + 1
            at -= n
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """``(times, pieces by length)``: the bins that minimum bin slack fills one by one, equal ones together.

    A combination is used as often as the pieces last: until then the same lengths are at hand, so the
    one-bin search would find it again. Each entry uses up a length or nearly so; the plan's size
    depends on the capacity, not on the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        chosen = fullest_bin(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        plan.append((times, chosen))
        for n, k in chosen.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
    return plan


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, piece, start, length, ids_crc32)``: each text's ids and the end id, cut only if longer than ``capacity``; then the first piece is the shorter one."""
    small_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(tokenizer_path)
        for batch in batches:
            at, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    at.append(k)
                    piece.append(i)
                    start.append(a)
                    length.append(z - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * z]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def numbered(pieces: DataFrame, counts: dict[int, int]) -> DataFrame:
    """``pieces`` with ``place``, gapless from 0 for each length, however many pieces have it.

    A length's pieces are dealt to buckets by a hash of ``row``, a number that was written with the piece, as many as its count
    asks for; a window numbers each bucket, and running totals over the small table of bucket sizes are added. So pieces
    with null or repeated ids fill no bucket.
    """
    by = "length"
    many = ",".join(str(max(1, -(-counts.get(n, 0) // BUCKET_ROWS))) for n in range(max(counts, default=0) + 1))
    buckets = F.get(F.split(F.lit(many), ","), F.col(by)).cast("long")
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("row"), buckets))
    sizes = dealt.groupBy(by, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = materialise(sizes.select(by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bucket-base")
    inside = F.row_number().over(Window.partitionBy(by, "bucket").orderBy("row"))
    return dealt.withColumn("inside", inside).join(base, [by, "bucket"]).withColumn("place", F.col("base") + F.col("inside") - 1).drop("bucket", "inside", "base")


class Plan:
    """Where the i-th piece of each length goes: spans of places, found by binary search."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        spans, sequence = [], 0
        used = dict.fromkeys(counts, 0)
        for times, chosen in plan_bins(counts, capacity):
            offset = 0
            for n in sorted(chosen, reverse=True):
                for _ in range(chosen[n]):
                    spans.append((n, used[n], sequence, offset))
                    used[n] += times
                    offset += n
            sequence += times
        spans.sort()
        self.length, self.low, self.first, self.offset = (np.array([x[j] for x in spans], np.int64) for j in range(4))
        self.begin = {n: int(np.searchsorted(self.length, n)) for n in counts}
        self.end = {n: int(np.searchsorted(self.length, n, "right")) for n in counts}

    def find(self, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(sequence, offset)`` of each piece."""
        at = np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            own = length == n
            a, z = self.begin[n], self.end[n]
            at[own] = a + np.searchsorted(self.low[a:z], place[own], "right") - 1
        return self.first[at] + place - self.low[at], self.offset[at]


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each piece of each document with its place: ``(id, piece, start, length, ids_crc32, sequence_id, offset)``.

    Minimum bin slack: per sequence, the longest piece left and the fullest combination of the others
    that fits, found by subset-sum dynamic programming on bitsets. Pieces of equal length are
    interchangeable, so the search runs on the driver over the counts of lengths (at most
    ``capacity`` numbers, whatever the input), and its plan (a bounded number of spans) is broadcast:
    the i-th piece of a length goes where the plan puts the i-th. Null and empty texts are one
    end id; repeated rows and null ids are packed like any other rows; an empty table packs nothing.
    """
    spark = docs.sparkSession
    pieces = token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    pieces = materialise(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = plan.value.find(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    placed = numbered(pieces, counts).select("id", "piece", "start", "length", "ids_crc32", "place")
    kind = docs.schema[id_col].dataType.simpleString()
    out = placed.mapInArrow(put, f"id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
