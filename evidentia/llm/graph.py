"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise


def _digest(edges: DataFrame) -> tuple:
    """A fingerprint of an edge set: equal for equal sets, whatever their order."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Stars of the graph with edges ``(u, v)``: rows ``(node, root)``, root the least node of the component.

    Large-star and small-star rounds alternate (Kiveris et al., SoCC 2014); each round is two
    aggregations and two joins, written to the shared folder, so that neither the driver nor one task
    ever holds a component. Minima are combined before the shuffle; those of the large star, where hubs
    are, are joined back as a table of their own, so that AQE can split the rows of a hub. Roots are not among the nodes. Self loops and
    nulls are ignored; an empty table gives an empty table.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialise(edges.filter("u <> v").distinct(), "edges")
    seen = _digest(edges)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        both = edges.union(edges.select("v", "u"))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star-min")
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.distinct().join(lowest.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, materialise(moved.union(lowest.select("u", "m")).distinct(), "stars")
        discard(before, least)
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
