"""Near-duplicate documents by SimHash fingerprints, found through pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise, number_of, numbered_columns, own_columns, row_key, small_batches
from evidentia.llm.graph import connected_components

BITS = 64
#: Shingles whose bits are counted at once, which bounds memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """SimHash of a text: bit i is 1 if over half of the shingles' XXH64 values have it. No words: 0."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = list(zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), BLOCK):
        part = np.array([digest(joined[a:z], seed) for a, z in spans[at : at + BLOCK]], ">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, hashes: bool = False) -> DataFrame:
    """``(id, fp)`` of each row; fp is the fingerprint as a signed long. With ``hashes`` also the text hashes of ``row_key``, ``h`` and ``g``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=["id", "fp", *batch.schema.names[2:]])

    kind = docs.schema[id_col].dataType.simpleString()
    _, h, g = row_key(id_col, text_col)
    also = [h.alias("h"), g.alias("g")] if hashes else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *also)
    return rows.mapInArrow(run, f"id {kind}, fp long" + ", h long, g long" * hashes)


def _segments(m: int) -> list[tuple[int, int]]:
    """``(first bit, bits)`` of m segments that together have all the bits."""
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bits(first: int, n: int) -> int:
    return ((1 << n) - 1) << first


class Ring:
    """The segments of a fingerprint as a ring, and the keys that its viable chains share.

    A chain of l consecutive segments is viable if, for each k up to l, its first k segments differ in at most
    ``budget * k // m`` bits. Of two fingerprints within ``budget`` bits some chain of any length is viable (Qin and
    Xiao, VLDB 2018). Keys come from the chains of ``LINKS`` segments: the first has no difference, each of the others
    is cut in ``PIECES``, and a shape names the pieces that may differ, as many as the chain's budget and so many of
    the first k segments as theirs. The bits outside the shape are the key, so two fingerprints with a viable chain share one.
    """

    LINKS, PIECES = 3, 3

    def __init__(self, budget: int, m: int) -> None:
        if not 0 <= budget < m <= BITS // self.PIECES or m < self.LINKS:
            raise ValueError("more segments than differing bits are needed")
        self.budget, self.m = budget, m
        self.segments = _segments(m)
        self.allowed = [budget * k // m for k in range(m + 1)]
        self.keys: list[tuple[int, int]] = []  # start and mask of each slot
        for start in range(m):
            chain = [self.segments[(start + d) % m] for d in range(self.LINKS)]
            pieces = [(d, a + n * p // self.PIECES, n * (p + 1) // self.PIECES - n * p // self.PIECES) for d, (a, n) in enumerate(chain) if d for p in range(self.PIECES)]
            whole = sum(_bits(a, n) for a, n in chain)
            for shape in combinations(pieces, self.allowed[self.LINKS]):
                if all(sum(d < k for d, _, _ in shape) <= self.allowed[k] for k in range(1, self.LINKS)):
                    self.keys.append((start, whole - sum(_bits(a, n) for _, a, n in shape)))
        if len(self.keys) > 64:
            raise ValueError("too many keys")

    def chain(self, start: int, length: int) -> int:
        """The bits of a chain."""
        return _signed(sum(_bits(*self.segments[(start + k) % self.m]) for k in range(length)))

    def keyed(self, fps: DataFrame) -> DataFrame:
        """``(fp, key)``, a row for each slot: a hash of the fingerprint's bits there, its last six bits the slot's number."""
        masks = F.array(*(F.lit(_signed(mask)) for _, mask in self.keys))
        rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(self.keys) - 1))).alias("slot"))
        hashed = F.xxhash64(F.col("fp").bitwiseAND(F.get(masks, F.col("slot"))), "slot")
        return rows.select("fp", hashed.bitwiseAND(F.lit(-64)).bitwiseOR(F.col("slot").cast("long")).alias("key"))

    def near(self, a: Column, b: Column, key: Column, once: bool) -> Column:
        """Candidates that share ``key``: its chain is viable at each length, then in full. With ``once`` only the pair's first viable start counts."""
        diff = a.bitwiseXOR(b)
        starts = F.array(*(F.lit(start) for start, _ in self.keys))
        start = F.get(starts, key.bitwiseAND(F.lit(63)).cast("int"))

        def within(k: int, at: Column) -> Column:
            return F.bit_count(diff.bitwiseAND(F.get(F.array(*(F.lit(self.chain(s, k)) for s in range(self.m))), at))) <= self.allowed[k]

        found = within(1, start)
        for k in range(2, self.m):
            found = found & within(k, start)
        found = found & (F.bit_count(diff) <= self.budget)
        for s in range(self.m - 1) if once else ():
            earlier = F.lit(True)
            for k in range(1, self.m):
                earlier = earlier & (F.bit_count(diff.bitwiseAND(F.lit(self.chain(s, k)))) <= self.allowed[k])
            found = found & ((start <= s) | ~earlier)
        return found


def link_fingerprints(fps: DataFrame, budget: int = 4, segments: int = 5) -> DataFrame:
    """``(fp, root)`` for distinct fingerprints ``fp`` linked, directly or through others, at ``budget`` bits or fewer.

    Candidates share a key of ``Ring``: by default 60 keys a fingerprint, each some 30 bits of a chain of three of five segments.
    First each key's least fingerprint is linked with its neighbours, one link a row, and components are contracted. Then only
    pairs from different components are compared: the chain grows segment by segment, the full check comes last. In each key
    group the rows outside its largest component meet all its rows. So a group of near copies costs rows in
    proportion to its size, and no link between components is lost. The pair conditions are part of the
    join, hence a failed candidate is never emitted. All joins are dealt by key at every size, so that AQE may split
    a hot one. Fingerprints without a link are not in the result.
    """
    ring = Ring(budget, segments)
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # the table is small beside its keys
    keyed = ring.keyed(fps.repartition(tasks, "fp"))
    groups = keyed.groupBy("key").agg(F.min("fp").alias("pivot"), F.max("fp").alias("other")).filter("pivot <> other").select("key", "pivot")
    shared = materialise(keyed.join(groups.hint("merge"), "key"), "simhash-keys")
    star = shared.filter(F.col("fp") != F.col("pivot")).filter(ring.near(F.col("fp"), F.col("pivot"), F.col("key"), once=False))
    first = connected_components(star.select(F.col("fp").alias("u"), F.col("pivot").alias("v")))

    named = shared.select("key", "fp").join(first.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
    named = materialise(named.select("key", "fp", F.coalesce("root", "fp").alias("root")), "simhash-named")
    discard(shared)
    sizes = named.groupBy("key", "root").count().groupBy("key")
    mixed = sizes.agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count("*").alias("roots")).filter("roots > 1")
    met = materialise(named.join(mixed.select("key", "main").hint("merge"), "key"), "simhash-met")
    discard(named)
    a = met.filter("root <> main").select(F.col("key").alias("key_a"), F.col("fp").alias("fp_a"), F.col("root").alias("root_a"))
    b = met.select("key", F.col("fp").alias("fp_b"), F.col("root").alias("root_b"), "main")
    fresh = (F.col("root_b") == F.col("main")) | (F.col("fp_a") < F.col("fp_b"))
    near = ring.near(F.col("fp_a"), F.col("fp_b"), F.col("key"), once=True)
    pairs = a.join(b.hint("merge"), (F.col("key_a") == F.col("key")) & (F.col("root_a") != F.col("root_b")) & fresh & near)
    second = connected_components(pairs.select(F.col("root_a").alias("u"), F.col("root_b").alias("v")))
    discard(met)
    second = second.select(F.col("node").alias("root"), F.col("root").alias("top"))
    inner = first.select(F.col("node").alias("fp"), "root").union(first.select(F.col("root").alias("fp"), "root").distinct())
    lone = second.select(F.col("root").alias("fp"), F.col("root")).union(second.select(F.col("top").alias("fp"), F.col("top").alias("root")).distinct())
    all_of = inner.union(lone.join(inner.select("fp").hint("merge"), "fp", "left_anti"))
    return all_of.join(second.hint("merge"), "root", "left").select("fp", F.coalesce("top", "root").alias("root"))


def _rooted(reps: DataFrame, budget: int, segments: int) -> DataFrame:
    """``(fp, least, root)``: distinct fingerprints with the root of their component, their own where none is linked."""
    linked = materialise(link_fingerprints(reps.select("fp"), budget, segments), "simhash-linked")
    return reps.join(linked.hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 4, segments: int = 5, width: int = 4) -> DataFrame:
    """One row for each row of ``docs``: its id, ``fp`` (signed long) and ``component_id``, the least id reachable by links.

    Links join fingerprints at ``budget`` or fewer differing bits; equal fingerprints are one node, so copies
    are never paired. Null and empty texts have fingerprint zero and are linked like any other. Null ids get
    the component of their fingerprint (null if all its ids are null). Repeated rows stay repeated. Other
    columns are not read. Fingerprints, links and components stay distributed: each step is a table in the
    shared folder.
    """
    fps = materialise(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    reps = materialise(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    rooted = _rooted(reps, budget, segments)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = materialise(rooted.join(least.hint("merge"), "root").select("fp", "component_id"), "simhash-components")
    discard(reps)
    return fps.join(known.hint("merge"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 4, segments: int = 5, width: int = 4) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row, that with the least id, then text hashes; null ids come last.

    Components are told apart by their links and rows by id and text hashes, so an id that repeats or is null costs no
    row of another component. Of rows that are equal in that key one stays. Names of other columns can't clash.
    """
    bare = numbered_columns(docs)
    own_id, own_text = number_of(docs, id_col), number_of(docs, text_col)
    fps = fingerprints(bare, own_id, own_text, width, hashes=True)
    keys = materialise(fps.groupBy("fp", "id", "h", "g").count(), "simhash-rows")
    key = F.struct(F.col("id").isNull().alias("last"), "id", "h", "g", "count")
    reps = materialise(keys.groupBy("fp").agg(F.min(key).alias("least")), "simhash-distinct")
    discard(keys)
    stay = _rooted(reps, budget, segments).groupBy("root").agg(F.min("least").alias("row"))
    stay = materialise(stay.select("row.id", "row.h", "row.g", F.col("row.count").alias("n")), "simhash-stay")
    discard(reps)
    own, h, g = row_key(own_id, own_text)
    kept = bare.withColumns({"own_h": h, "own_g": g})
    kept = kept.join(stay.hint("merge"), own.eqNullSafe(F.col("id")) & (F.col("own_h") == F.col("h")) & (F.col("own_g") == F.col("g")), "left_semi")
    if stay.filter("n > 1").limit(1).count():
        kept = kept.dropDuplicates([own_id, "own_h", "own_g"])
    return kept.select(*own_columns(docs))
