"""Ordered funnels: how many attempts of each client reach each step, and how long the steps take."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from evidentia.llm.common import discard, materialise


@dataclass(frozen=True)
class Funnel:
    """Kinds in the order of their steps, and the kind that ends an attempt when it comes between two of them."""

    steps: tuple[str, ...]
    excluding: str


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time with or without a zone; the session's zone plays no part in the latter."""
    if not isinstance(df.schema[column].dataType, TimestampNTZType):
        return F.unix_micros(F.col(column))
    at = F.col(column)
    seconds = (F.unix_date(at.cast("date")).cast("long") * 24 + F.hour(at)) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("long")


def in_blocks(df: DataFrame, *order: str) -> DataFrame:
    """``df`` dealt by ranges of ``order`` and written, with the number of its range as ``block``.

    Equal values of ``order`` share a range, and a key with very many rows takes many ranges; so a running number
    over such a key is one inside a block plus the sums of the blocks before.
    """
    return materialise(df.repartitionByRange(*order).withColumn("block", F.spark_partition_id()), "blocks")


def before_blocks(blocked: DataFrame, keys: list[str], sums: Mapping[str, Column]) -> DataFrame:
    """``(keys, block, before_x, all_x)``: each sum over the earlier blocks of the key and over all of them.

    A row for each block in which a key occurs, so the window sees at most as many rows of a key as there are blocks.
    """
    totals = blocked.groupBy(*keys, "block").agg(*(F.sum(c).alias(x) for x, c in sums.items()))
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = [c for x in sums for c in (F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"before_{x}"), F.sum(x).over(by_key).alias(f"all_{x}"))]
    return totals.select(*keys, "block", *found)


def _counted(rows: DataFrame, kinds: list[str]) -> DataFrame:
    """Each row with ``c0, c1, ...``: how many rows of each of ``kinds`` its client has up to its time, itself and ties included."""
    blocked = in_blocks(rows, "client", "ts")
    is_kind = {f"k{i}": (F.col("kind") == k).cast("long") for i, k in enumerate(kinds)}
    through = Window.partitionBy("client", "block").orderBy("ts").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = blocked.select("client", "kind", "ts", "block", *(F.sum(c).over(through).alias(k) for k, c in is_kind.items()))
    both = inside.join(before_blocks(blocked, ["client"], is_kind).hint("merge"), ["client", "block"])
    counts = [(F.col(f"k{i}") + F.col(f"before_k{i}")).alias(f"c{i}") for i in range(len(kinds))]
    found = materialise(both.select("client", "kind", "ts", *counts), "counted")
    discard(blocked)
    return found


def _of_funnel(funnels: Mapping[str, Funnel], value) -> Column:
    """``value(funnel)`` of the row's funnel."""
    found = F.lit(None)
    for name, funnel in funnels.items():
        found = F.when(F.col("funnel") == name, value(funnel)).otherwise(found)
    return found


def _ranked(times: DataFrame, percent: int) -> DataFrame:
    """``(funnel, client, step, n, t)``: attempts, and the ``ceil(percent * n / 100)``-th smallest of their times ``t``, each counted ``w`` times."""
    group = ["funnel", "client", "step"]
    blocked = in_blocks(times.groupBy(*group, "t").agg(F.sum("w").alias("w")), *group, "t")
    target = F.expr(f"({percent} * all_w + 99) div 100")
    before = before_blocks(blocked, group, {"w": F.col("w")}).withColumn("target", target).filter("before_w < target")
    # The block that holds the target is the last one that begins before it.
    last = before.groupBy(*group).agg(F.max_by(F.struct("block", "before_w", "target", "all_w"), "block").alias("b")).select(*group, "b.*")
    inside = Window.partitionBy(*group, "block").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = blocked.join(last.hint("merge"), [*group, "block"]).withColumn("through", F.sum("w").over(inside) + F.col("before_w"))
    found = materialise(reached.filter("through >= target").groupBy(*group).agg(F.first("all_w").alias("n"), F.min("t").alias("t")), "ranked")
    discard(blocked)
    return found


def count_funnels(events: DataFrame, funnels: Mapping[str, Funnel], minutes: int = 60, percent: int = 90, client_col: str = "client_id", kind_col: str = "kind", time_col: str = "ts") -> DataFrame:
    """``(funnel, client, n1, ..., deepest, t2, ..., same_depth)`` for each funnel and client with attempts.

    A row of a funnel's first kind starts an attempt. Its next step is the client's earliest row of the next kind
    at a later time; the attempt reaches it unless it comes over ``minutes`` later or a row of the excluded kind lies after the
    step before and not after it. ``n1``, ``n2``, ... count attempts by step, ``deepest`` is the last step that any of them
    reached, ``t2``, ``t3``, ... are the ``ceil(percent * n / 100)``-th smallest times from step to step in microseconds (null
    if no attempt got there), and ``same_depth`` counts the clients of equal funnel and ``deepest``.

    Counts of each kind through each time tell the number of the next occurrence, which an equality join on client, kind
    and number finds; the difference of two counts of the excluded kind verifies it. Counts are made in blocks of
    ranges of (client, time), so the rows of one client, however many, are dealt to many tasks; ranks of times likewise.
    Attempts that meet in one row go on as one row with their number. What is broadcast has a row for each funnel and step.

    Rows count once for each distinct (client, kind, time); those with a null among the three are left out, and other
    columns play no part. Rows of one time are in no order: neither is later than the other. Kinds of no funnel are
    ignored. An empty table gives an empty result. A client whose attempts are all at step one has null times.
    """
    kinds = sorted({k for f in funnels.values() for k in (*f.steps, f.excluding)})
    number = {k: f"c{i}" for i, k in enumerate(kinds)}
    depth = max(len(f.steps) for f in funnels.values())
    rows = events.select(F.col(client_col).alias("client"), F.col(kind_col).alias("kind"), micros(events, time_col).alias("ts"))
    rows = rows.filter(F.col("client").isNotNull() & F.col("ts").isNotNull() & F.col("kind").isin(kinds)).distinct()
    counted = _counted(rows, kinds)

    own = F.coalesce(*(F.when(F.col("kind") == k, F.col(c)) for k, c in number.items()))
    targets = counted.select("client", F.col("kind").alias("want"), own.alias("ordinal"), F.col("ts").alias("at"), *(F.col(c).alias(f"to_{c}") for c in number.values()))
    starts = F.array_compact(F.array(*(F.when(F.col("kind") == f.steps[0], F.lit(name)) for name, f in funnels.items())))
    at_step = counted.select(F.explode(starts).alias("funnel"), "client", "ts", *number.values(), F.lit(1).cast("long").alias("w"))

    reached = []
    for step in range(2, depth + 1):
        longer = {name: f for name, f in funnels.items() if len(f.steps) >= step}
        wanted = _of_funnel(longer, lambda f: F.lit(f.steps[step - 1]))
        ordinal = _of_funnel(longer, lambda f: F.col(number[f.steps[step - 1]])) + 1
        ended = _of_funnel(longer, lambda f: F.col(number[f.excluding]))
        ended_there = _of_funnel(longer, lambda f: F.col(f"to_{number[f.excluding]}"))
        asked = at_step.filter(F.col("funnel").isin(list(longer))).select("funnel", "client", "ts", "w", wanted.alias("want"), ordinal.alias("ordinal"), ended.alias("ended"))
        met = asked.join(targets.hint("merge"), ["client", "want", "ordinal"]).filter((F.col("at") - F.col("ts") <= minutes * 60_000_000) & (ended_there == F.col("ended")))
        met = met.select("funnel", "client", F.lit(step).alias("step"), (F.col("at") - F.col("ts")).alias("t"), "w", F.col("at").alias("ts"), *(F.col(f"to_{c}").alias(c) for c in number.values()))
        reached.append(materialise(met, f"step{step}"))
        at_step = reached[-1].groupBy("funnel", "client", "ts", *number.values()).agg(F.sum("w").alias("w"))

    times = reached[0].select("funnel", "client", "step", "t", "w")
    for more in reached[1:]:
        times = times.union(more.select("funnel", "client", "step", "t", "w"))
    ranked = _ranked(times, percent)

    first = counted.groupBy("client").agg(*(F.count_if(F.col("kind") == k).alias(c) for k, c in number.items()))
    pairs = F.array(*(F.struct(F.lit(name).alias("funnel"), F.col(number[f.steps[0]]).alias("n")) for name, f in funnels.items()))
    first = first.select("client", F.inline(pairs)).filter("n > 0").select("funnel", "client", F.lit(1).alias("step"), "n", F.lit(None).cast("long").alias("t"))
    at = lambda k, c: F.max(F.when(F.col("step") == k, F.col(c)))
    counts = [F.coalesce(at(k, "n"), F.lit(0)).cast("long").alias(f"n{k}") for k in range(1, depth + 1)]
    by_client = first.union(ranked).groupBy("funnel", "client").agg(*counts, F.max("step").alias("deepest"), *(at(k, "t").alias(f"t{k}") for k in range(2, depth + 1)))
    by_client = materialise(by_client, "funnel-clients")
    discard(counted, ranked, *reached)
    same = by_client.groupBy("funnel", "deepest").agg(F.count("*").alias("same_depth"))
    out = by_client.join(F.broadcast(same), ["funnel", "deepest"])
    return out.select("funnel", F.col("client").alias(client_col), *(f"n{k}" for k in range(1, depth + 1)), "deepest", *(f"t{k}" for k in range(2, depth + 1)), "same_depth")
