"""Connected components of a graph of links, by alternating large and small stars (Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dropped, staged


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of links (u, v long) but the components' smallest nodes; component is the smallest node reachable.

    Each round hangs every node's larger neighbours on the smallest node near it, then every node and its smaller neighbours, so that
    the number of rounds grows with the logarithm of the longest chain. The links of a round are written to the shared folder. Neighbours
    are never gathered: a node's smallest one is an aggregate that is joined back. Links from a node to itself and repeated links don't
    matter.
    """
    u, v = F.col("u"), F.col("v")
    edges = staged(links.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "links")
    mark = _mark(edges)
    for _ in range(max_rounds if mark[0] else 0):
        both = edges.union(edges.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        large = both.join(low, "u").filter(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        small = hung.filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after = staged(small.distinct(), "links")
        dropped(edges)
        edges, before = after, mark
        mark = _mark(edges)
        if mark == before:
            break
    else:
        if mark[0]:
            raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return edges.select(u.alias("node"), v.alias("component"))
