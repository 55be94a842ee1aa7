"""Incremental collection: landed files are upserted into a table, micro-batch by micro-batch."""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from evidentia.operators.merge import keep_last, upsert_owned
from evidentia.plans.versions import Versions


#: Buckets of keys, parts of one level that become one of the next, and versions whose parts are kept for readers.
BUCKETS, FAN_IN, KEPT = 16, 4, 2
_MANIFEST = "kind string, name string, level int, number long"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


class MergedTable:
    """A keyed table in parts by level; a reader takes the last row of each key.

    A batch writes its own rows, the last of each key, as a part of level 0, in buckets of keys. FAN_IN parts of a level are merged into
    one of the next, so n batches write each row about log n times. A version of the manifest lists the parts and, for each
    stream, the last batch that they hold: a batch that is replayed is known and changes nothing. Parts that no
    kept version has are deleted; a reader of the version before still finds its own.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, ordinal: str) -> None:
        self.spark, self.path, self.key, self.ordinal = spark, path.rstrip("/"), key, ordinal
        self.versions = Versions(spark, path, _MANIFEST)

    def _state(self, version: int | None = None) -> tuple[list[tuple[str, int]], dict[str, int]]:
        rows = self.versions.rows(version)
        return sorted((name, level) for kind, name, level, _ in rows if kind == "part"), {name: number for kind, name, _, number in rows if kind == "stream"}

    def _publish(self, parts: list[tuple[str, int]], streams: dict[str, int]) -> None:
        self.versions.publish([*(("part", n, level, None) for n, level in parts), *(("stream", n, None, k) for n, k in streams.items())])

    def _store(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.withColumn("_bucket", bucket_of(self.key)).repartition(BUCKETS, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/parts/{name}")
        return name

    def _union(self, parts: list[str]) -> DataFrame | None:
        held = [p for p in parts if any(n.startswith("_bucket=") for n in self.versions.names("parts", p))]
        return keep_last(reduce(DataFrame.unionByName, (self.spark.read.parquet(f"{self.path}/parts/{p}") for p in held)), ["_bucket", self.key], self.ordinal) if held else None

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, of a kept version or some buckets alone if told; None before the first row."""
        found = self._union([name for name, _ in self._state(version)[0]])
        if found is not None and buckets is not None:
            found = found.filter(F.col("_bucket").isin(buckets))
        return None if found is None else found.drop("_bucket")

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """The rows of ``keys`` (one column, that of the key); only their buckets are read."""
        found = self.read(buckets=[r[0] for r in keys.select(bucket_of(self.key)).distinct().collect()])
        return None if found is None else found.join(keys, self.key, "left_semi")

    def add(self, rows: DataFrame, stream: str = "", number: int = -1) -> bool:
        """Adds a batch, and merges levels that are full; False if this batch of the stream is in already. A number below 0 is always added."""
        parts, streams = self._state()
        if 0 <= number <= streams.get(stream, -1):
            return False
        parts.append((self._store(keep_last(rows, [self.key], self.ordinal)), 0))
        if number >= 0:
            streams[stream] = number
        while full := [level for level in {n for _, n in parts} if sum(n == level for _, n in parts) >= FAN_IN]:
            level = min(full)
            old = [name for name, n in parts if n == level]
            merged = self._union(old)
            parts = [(name, n) for name, n in parts if n != level]
            if merged is not None:
                parts.append((self._store(merged.drop("_bucket")), level + 1))
        self._publish(parts, streams)
        live = {name for v in self.versions.keep_last(KEPT) for name, _ in self._state(v)[0]}
        for name in self.versions.names("parts"):
            if name not in live:
                self.versions.drop("parts", name)
        return True


def collect(spark: SparkSession, landing: str, schema: StructType, table: str, key: str, ordinal: str, checkpoint: str | None = None) -> DataFrame:
    """Upserts everything in the landing folder, a few files at a time, the greatest ordinal of a key wins; a second call takes only new files.

    The stream's checkpoint remembers files and the table the stream's last batch, so a batch may be
    replayed, and files may land in any order, with the same result.
    """
    target = MergedTable(spark, table, key, ordinal)
    _drain(spark, landing, schema, lambda batch, stream, number: target.add(batch, stream, number), checkpoint or f"{table}-checkpoint-{uuid.uuid4().hex}")
    out = target.read()
    return spark.createDataFrame([], schema) if out is None else out


def collect_owned(spark: SparkSession, landing: str, schema: StructType, table: str, key: str, address: Column, ordinal: str, checkpoint: str | None = None) -> DataFrame:
    """As ``collect``, for a registry in which an address belongs to one key at a time (``merge.upsert_owned``): each batch is replayed
    against what the table holds, and the rows that a key then holds anew are added. Files count in the order in which they are taken."""
    target = MergedTable(spark, table, key, "_turn")

    def add(batch: DataFrame, stream: str, number: int) -> None:
        held = target.read()
        held = spark.createDataFrame([], schema) if held is None else held.drop("_turn")
        after = upsert_owned(held, batch, key, address, ordinal)
        target.add(after.exceptAll(held).withColumn("_turn", F.lit(number).cast("long")), stream, number)

    _drain(spark, landing, schema, add, checkpoint or f"{table}-checkpoint-{uuid.uuid4().hex}")
    out = target.read()
    return spark.createDataFrame([], schema) if out is None else out.drop("_turn")


def _drain(spark: SparkSession, landing: str, schema: StructType, add, checkpoint: str) -> None:
    """Hands what lies in the landing folder to ``add(batch, stream, number)``, a few files at a time."""
    tag = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(landing)
    query = stream.writeStream.foreachBatch(lambda batch, number: add(batch, tag, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def windowed_counts(events: DataFrame, time_col: str, kind_col: str, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Tumbling counts; on a stream a watermark bounds the state."""
    marked = events.withWatermark(time_col, late) if events.isStreaming else events
    return marked.groupBy(F.window(time_col, width).alias("w"), kind_col).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind_col, "n")
