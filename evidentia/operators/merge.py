"""Keyed merges: the upsert rules of the registry, of facts and of queues. Each returns a new table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.plans.shared import delete, written

TRIPLE = ("subject", "predicate", "object")
TYPED_TRIPLE = ("subject", "subject_type", "predicate", "object", "object_type")


def keep_one(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def keep_last(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """The row of each key with the greatest ordinal; combined before the shuffle, so a key may have any number of rows."""
    return _best(df, key, F.max_by, ordinal)


def keep_first(df: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    return _best(df, key, F.min_by, ordinal)


def _best(df: DataFrame, key: list[str], pick, ordinal: str) -> DataFrame:
    return df.groupBy(*key).agg(pick(F.struct(*df.columns), F.col(ordinal)).alias("_row")).select("_row.*")


def upsert(existing: DataFrame, new: DataFrame, key: list[str], ordinal: str) -> DataFrame:
    """Last wins by key: new rows, the last of each key, replace existing ones."""
    fresh = keep_last(new, key, ordinal)
    return existing.join(fresh.select(*key), key, "left_anti").unionByName(fresh)


def components(edges: DataFrame) -> DataFrame:
    """``(u, root)`` for each ``u`` of the edges ``(u, v)``: the least ``u`` that it is linked with through common ``v``.

    Roots are passed on over ``v`` and each is replaced by its own root, so paths of any length take few rounds; each
    round is written and the one before deleted.
    """
    edges = written(edges.distinct(), "links")
    now = written(edges.select("u", F.col("u").alias("root")).distinct(), "roots")
    while True:
        over = edges.join(now, "u").groupBy("v").agg(F.min("root").alias("root"))
        near = edges.join(over, "v").groupBy("u").agg(F.min("root").alias("near"))
        step = now.join(near, "u").select("u", "root", F.least("root", "near").alias("near"))
        onward = now.select(F.col("u").alias("near"), F.col("root").alias("far"))
        after = written(step.join(onward, "near").select("u", F.least("near", "far").alias("root"), (F.least("near", "far") < F.col("root")).alias("moved")), "roots")
        delete(now)
        now = after.drop("moved")
        now._path = after._path
        if after.filter("moved").isEmpty():
            delete(edges)
            return now


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(root, id, address, fresh, ordinal)`` in order of root and time: the rows that ids hold in the end."""
    root, held, owners, done = None, {}, {}, []
    for batch in batches:
        for at, key, address, fresh, ordinal in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != root:
                done += [(k, *row) for k, (_, *row) in held.items()]
                root, held, owners = at, {}, {}
            owner = owners.get(address)
            if fresh and owner is not None and owner != key:
                continue
            if fresh and key in held:
                owners.pop(held[key][0], None)
            held[key] = (address, fresh, ordinal)
            owners[address] = key
        yield _rows_of(done, batch)
        done = []
    if root is not None:
        yield _rows_of([(k, *row) for k, (_, *row) in held.items()], batch)


def _rows_of(rows: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    types = [like.schema.field(n).type for n in ("id", "fresh", "ordinal")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "fresh", "ordinal"])


def upsert_owned(existing: DataFrame, new: DataFrame, key: str, address: Column, ordinal: str) -> DataFrame:
    """As ``upsert``, but a new row whose address another key holds at that moment is dropped; what a key gives up is free again.

    New rows count in the order of ``ordinal`` (then of keys), after the last existing row of each key. Keys whose
    addresses no other key ever has need no order beyond their own last row. The others are replayed: one stream of
    (key, address, ordinal) rows for each component of keys that are linked by addresses, in a task that
    remembers what the keys of the component hold, and no row's other columns.
    """
    last = keep_last(existing, [key], ordinal)
    both = last.withColumn("_fresh", F.lit(0)).unionByName(new.withColumn("_fresh", F.lit(1))).withColumn("_address", address)
    both = written(both, "claims")
    claims = both.select(F.col(key).alias("id"), F.col("_address").alias("address"), F.col("_fresh").alias("fresh"), F.col(ordinal).alias("ordinal"))
    shared = claims.groupBy("address").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a <> z").select("address")
    roots = components(claims.join(shared, "address").select(F.col("id").alias("u"), F.col("address").alias("v")))
    told = claims.join(roots.withColumnRenamed("u", "id"), "id").select("root", "id", "address", "fresh", "ordinal")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in told.schema if f.name in ("id", "fresh", "ordinal"))
    in_order = told.repartition("root").sortWithinPartitions("root", "fresh", "ordinal", "id")
    won = in_order.mapInArrow(_replayed, kinds).select(F.col("id").alias(key), F.col("fresh").alias("_fresh"), F.col("ordinal").alias(ordinal))
    replayed = keep_one(both.join(won, [key, "_fresh", ordinal], "left_semi"), [key], F.asc("_address"))
    alone = both.join(roots.select(F.col("u").alias(key)), key, "left_anti")
    rank = F.struct("_fresh", ordinal)
    alone = alone.groupBy(key).agg(F.max_by(F.struct(*both.columns), rank).alias("_row")).select("_row.*")
    return replayed.unionByName(alone).select(*existing.columns)


def merge_extracted(existing: DataFrame, extracted: DataFrame) -> DataFrame:
    """Reviewed facts stay; extracted ones join unless their id is reviewed or their triple is there; the least id has a triple."""
    reviewed = existing.filter("verified or manual_checked")
    fresh = extracted.join(reviewed.select("fact_id"), "fact_id", "left_anti").join(reviewed.select(*TRIPLE), list(TRIPLE), "left_anti")
    return reviewed.unionByName(keep_one(fresh, list(TRIPLE), F.asc("fact_id")).select(*reviewed.columns))


def merge_generated(existing: DataFrame, generated: DataFrame, prefix: str) -> DataFrame:
    """Facts of the prefix that nobody checked are replaced by generated ones whose triple is not there; ``retained`` marks those."""
    kept = existing.filter(~F.startswith("evidence_source_id", F.lit(prefix)) | F.col("manual_checked"))
    fresh = keep_one(generated.join(kept.select(*TRIPLE), list(TRIPLE), "left_anti"), list(TRIPLE), F.asc("fact_id"))
    kept = kept.join(fresh.select("fact_id"), "fact_id", "left_anti")
    return kept.withColumn("retained", F.lit(False)).unionByName(fresh.select(*kept.columns).withColumn("retained", F.lit(True)))


def merge_owned(existing: DataFrame, generated: DataFrame, key: tuple[str, ...] = TRIPLE) -> tuple[DataFrame, DataFrame]:
    """``(merged, skipped)``: generated facts overwrite their own id, but are skipped if another id owns their key (the greatest existing id)."""
    owners = existing.groupBy(*key).agg(F.max("fact_id").alias("owner"))
    met = generated.join(owners, list(key), "left")
    free = met.filter("owner is null or owner = fact_id").drop("owner")
    fresh = keep_one(free, list(key), F.asc("fact_id"))
    taken = free.join(fresh.select("fact_id"), "fact_id", "left_anti").join(fresh.select(*key, F.col("fact_id").alias("owner")), list(key))
    skipped = met.filter("owner is not null and owner <> fact_id").select("fact_id", "owner").union(taken.select("fact_id", "owner"))
    merged = existing.join(fresh.select("fact_id"), "fact_id", "left_anti").unionByName(fresh.select(*existing.columns))
    return merged, skipped


def preserve_state(configured: DataFrame, existing: DataFrame, always: list[str], unless_pending: list[str], key: str = "source_id") -> DataFrame:
    """Configured rows with the existing rows' ``always`` columns, and ``unless_pending`` ones where collection had begun."""
    old = existing.select(F.col(key), F.struct(*existing.columns).alias("_old"))
    both = configured.join(old, key, "left")
    begun = F.col("_old").isNotNull() & (F.col("_old.crawl_status") != "pending")
    changes = {c: F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)) for c in always}
    changes |= {c: F.when(begun, F.col(f"_old.{c}")).otherwise(F.col(c)) for c in unless_pending}
    return both.withColumns(changes).drop("_old").select(*configured.columns)
