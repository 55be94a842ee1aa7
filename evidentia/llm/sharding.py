"""Sharding by fixed virtual slots and a versioned map from slots to shards."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.common import materialise

#: Virtual slots; a hash of its text puts each record in one.
SLOTS = 4096
#: Rows that one window task numbers, about.
BUCKET_ROWS = 10_000


def slot_of(text: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a record: equal texts share one."""
    return F.pmod(F.xxhash64(text), F.lit(slots)).cast("int")


def first_map(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Slot to shard: slots by falling size, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(sizes, key=lambda k: (-sizes[k], k)):
        total, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (total + sizes[slot], shard))
    return out


def edited_map(old: dict[int, int], sizes: dict[int, int], shards: int, tolerance: float = 0.01) -> dict[int, int]:
    """``old`` with as few slots moved as bring every shard within ``tolerance`` of the mean.

    New slots and slots of shards that are gone go to the emptiest shard; then the fullest shard gives the
    emptiest one its largest slot that narrows the gap, until no move helps.
    """
    out = {k: s for k, s in old.items() if s < shards and k in sizes}
    load = [0] * shards
    own: list[set[int]] = [set() for _ in range(shards)]
    for k, s in out.items():
        load[s] += sizes[k]
        own[s].add(k)
    for k in sorted(sizes.keys() - out.keys(), key=lambda k: (-sizes[k], k)):
        s = min(range(shards), key=lambda i: (load[i], i))
        out[k], load[s] = s, load[s] + sizes[k]
        own[s].add(k)
    mean = sum(load) / shards
    while True:
        high, low = max(range(shards), key=lambda i: (load[i], -i)), min(range(shards), key=lambda i: (load[i], i))
        if load[high] - mean <= tolerance * mean and mean - load[low] <= tolerance * mean:
            return out
        fits = [k for k in own[high] if 0 < sizes[k] < load[high] - load[low]]
        if not fits:
            return out
        k = min(fits, key=lambda k: (abs(2 * sizes[k] - (load[high] - load[low])), k))
        own[high].remove(k)
        own[low].add(k)
        out[k], load[high], load[low] = low, load[high] - sizes[k], load[low] + sizes[k]


#: A unit that is split: a slot, or one text of it (its two hashes); and the numbers of its parts.
Splits = dict[tuple[int, int | None, int | None], list[int]]


def slot_sizes(rows: DataFrame, shards: int, slots: int = SLOTS, splits: Splits | None = None) -> tuple[dict[int, int], Splits, list[int]]:
    """``(bytes by part, splits, repeated)`` of rows ``(vslot, mix, text_hash, text_crc32, deal, spread, size)``; ``splits`` are those of the map's version before.

    A slot that alone holds more than a shard's fair share is split into parts by a hash of the text, which keeps
    equal texts together; part p > 0 of a slot has the number ``slot + p * slots``. A text that alone holds more than a fair share
    is split into parts of its own: only its copies part. A split once made stays, whatever today's sizes are; when
    a part of it holds more than a fair share its parts are doubled, and each row stays or goes to its part's new twin.
    ``repeated`` are values of ``deal`` that alone hold an eighth of a fair share: rows that repeat an id and text, dealt by number.
    The driver reads at most ``slots`` sums, and the sums of split slots and texts, of which there are fewer than ``shards`` a version.
    """
    splits = {k: list(v) for k, v in (splits or {}).items()}
    whole = {r[0]: r[1] for r in rows.groupBy("vslot").agg(F.sum("size")).collect()}
    fair = max(1.0, sum(whole.values()) / shards)

    def grow(key: tuple, n: int) -> None:
        used = max((p for (k, *_), parts in splits.items() if k == key[0] for p in parts), default=-1)
        splits[key] = splits.get(key, []) + list(range(used + 1, used + 1 + n))

    for k, v in sorted(whole.items()):
        if v > fair and (k, None, None) not in splits:
            grow((k, None, None), min(4 * shards, int(8 * v / fair) + 1))
    split = sorted({k for k, *_ in splits})
    if not split:
        return whole, splits, []
    own = rows.filter(F.col("vslot").isin(split))
    texts = own.groupBy("vslot", "text_hash", "text_crc32").agg(F.sum("size").alias("size")).filter(F.col("size") > fair)
    for *key, v in sorted(tuple(r) for r in texts.collect()):
        if tuple(key) not in splits:
            grow(tuple(key), min(4 * shards, int(4 * v / fair) + 1))
    repeated = [r[0] for r in own.groupBy("deal").agg(F.sum("size").alias("size")).filter(F.col("size") > fair / 8).collect()]
    while True:
        parts = {r[0]: r[1] for r in own.groupBy(part_of(splits, repeated, slots).alias("part")).agg(F.sum("size")).collect()}
        full = [key for key, numbers in splits.items() if len(numbers) < 4 * shards and any(parts.get(key[0] + p * slots, 0) > fair for p in numbers)]
        if not full:
            return {k: v for k, v in whole.items() if k not in split} | parts, splits, repeated
        for key in full:
            grow(key, len(splits[key]))


def part_of(splits: Splits, repeated: list[int], slots: int = SLOTS) -> Column:
    """The part of a row: its slot, a part of a split slot by text, or a part of a split text by copy."""
    deal = F.when(F.col("deal").isin(repeated), F.col("spread")).otherwise(F.col("deal")) if repeated else F.col("deal")
    out = F.col("vslot")
    for (k, h, c), numbers in sorted(splits.items(), key=lambda x: (x[0][0], x[0][1] is not None, x[0][1:] if x[0][1] is not None else ())):
        unit = F.col("vslot") == k if h is None else (F.col("vslot") == k) & (F.col("text_hash") == h) & (F.col("text_crc32") == c)
        place = F.pmod(F.col("mix") if h is None else deal, F.lit(len(numbers))).cast("int") + 1
        out = F.when(unit, (k + F.element_at(F.array(*map(F.lit, numbers)), place) * slots).cast("int")).otherwise(out)
    return out


def splits_table(spark, splits: Splits, version: int) -> DataFrame:
    """The splits of a version as rows, to be appended to the stored ones."""
    row = lambda k, h, c, numbers: F.struct(F.lit(version).alias("version"), F.lit(k).alias("vslot"), F.lit(h).cast("long").alias("text_hash"), F.lit(c).cast("long").alias("text_crc32"), F.array(*map(F.lit, numbers)).alias("parts"))
    every = F.array(*(row(*key, numbers) for key, numbers in splits.items())) if splits else F.array().cast("array<struct<version int, vslot int, text_hash long, text_crc32 long, parts array<int>>>")
    return spark.range(1).coalesce(1).select(F.inline(every))


def read_splits(table: DataFrame, version: int) -> Splits:
    return {(r.vslot, r.text_hash, r.text_crc32): list(r.parts) for r in table.filter(F.col("version") == version).collect()}


def map_table(spark, mapping: dict[int, int], sizes: dict[int, int], version: int) -> DataFrame:
    """The map as rows ``(version, part, shard, bytes)``, to be appended to the stored versions."""
    rows = "".join(f"{k}:{s}:{sizes.get(k, 0)}," for k, s in sorted(mapping.items())).rstrip(",")
    one = spark.range(1).select(F.explode(F.split(F.lit(rows), ",")).alias("x")).select(F.split("x", ":").alias("x"))
    return one.filter("size(x) = 3").select(F.lit(version).alias("version"), *(F.col("x")[i].cast(t).alias(c) for i, (c, t) in enumerate((("part", "int"), ("shard", "int"), ("bytes", "long")))))


def read_map(maps: DataFrame, version: int | None = None) -> dict[int, int]:
    """Part to shard of a stored version (the newest if None); a version has a bounded number of rows."""
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return {r[0]: r[1] for r in maps.filter(F.col("version") == version).select("part", "shard").collect()}


def rebalance(maps: DataFrame, sizes: dict[int, int], shards: int, tolerance: float = 0.01) -> DataFrame:
    """The stored versions and one more, edited for new sizes or another number of shards."""
    version = maps.agg(F.max("version")).first()[0]
    new = edited_map(read_map(maps, version), sizes, shards, tolerance)
    return maps.unionByName(map_table(maps.sparkSession, new, sizes, version + 1))


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32, vslot, mix, text_hash, deal, spread)`` of each row, written: what slots, parts and places are made of.

    ``deal`` parts the copies of a split text: a hash of id and text, so that a row keeps its part when others come; rows without an id
    are dealt by their number. ``spread`` numbers rows and decides nothing but which task counts a row's place.
    """
    text = F.col(text_col).cast("string")
    whole, number = F.coalesce(text, F.lit("")), F.monotonically_increasing_id()
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        slot_of(whole, slots).alias("vslot"),
        F.xxhash64(F.lit(3), whole).alias("mix"),
        F.xxhash64(whole).alias("text_hash"),
        F.when(F.col(id_col).isNull(), F.xxhash64(number)).otherwise(F.xxhash64(F.lit(5), F.col(id_col), whole)).alias("deal"),
        F.xxhash64(number).alias("spread"),
    )
    return materialise(rows, "shard-rows")


def next_version(rows: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None) -> tuple[DataFrame, Column]:
    """The map ``(part, shard)`` for these ``records``, and a row's part: a first map or, where ``map_path`` has some, the newest one
    edited. It is appended there as the next version, with its splits."""
    spark = rows.sparkSession
    maps = _stored(spark, map_path and f"{map_path}/maps")
    before = maps.agg(F.max("version")).first()[0] if maps is not None else 0
    sizes, splits, repeated = slot_sizes(rows, shards, slots, read_splits(_stored(spark, f"{map_path}/splits"), before) if before else None)
    mapping = edited_map(read_map(maps, before), sizes, shards) if before else first_map(sizes, shards)
    table = map_table(spark, mapping, sizes, before + 1)
    if map_path:
        splits_table(spark, splits, before + 1).write.mode("append").parquet(f"{map_path}/splits")
        table.write.mode("append").parquet(f"{map_path}/maps")
        table = spark.read.parquet(f"{map_path}/maps").filter(F.col("version") == before + 1)
    return table.select("part", "shard"), part_of(splits, repeated, slots)


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None) -> DataFrame:
    """``(id, size, text_crc32, vslot, part, shard, place)`` for each row: shards of near equal bytes.

    A record's slot is a hash of its text and never changes; bytes are summed by slot, and a map from slots
    to shards is made or, where ``map_path`` has one, edited and appended as its next version, with the splits of heavy
    slots and texts: a row changes its part only when its part is split further. ``place`` is gapless
    from 0 in each shard. Size: UTF-8 bytes of the text (null: none) plus 1. Equal texts share a shard
    unless they alone exceed a shard's fair share. Repeated rows and null ids are records like any other; copies of a split
    text that have no id, or whose id many have, are dealt by the row's number.
    """
    rows = records(docs, slots, id_col, text_col)
    table, part = next_version(rows, shards, slots, map_path)
    # A map has a row for each slot and part at most.
    placed = rows.withColumn("part", part).join(F.broadcast(table), "part")
    # Places: rows are dealt to buckets by their number; running totals of the buckets' counts are added to a window's numbers.
    n = max(1, -(-rows.count() // BUCKET_ROWS))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("spread"), F.lit(n)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = materialise(counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "shard-base")
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("spread"))
    out = placed.withColumn("inside", inside).join(base, ["shard", "bucket"])
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "vslot", "part", "shard", (F.col("base") + F.col("inside") - 1).alias("place"))


def _stored(spark, path: str | None) -> DataFrame | None:
    if not path:
        return None
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return materialise(spark.read.parquet(path), "shard-maps")
