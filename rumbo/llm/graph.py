"""Connected components of an edge list by alternating star contraction.

Every round is two groupings and two joins on node ids, so the work is spread
by node and nothing is gathered: the large star step links each node's larger
neighbours to its smallest neighbour, the small star step links its smaller
ones.  A hub with a third of all edges is pre-aggregated by the partial
``min`` before the shuffle and its rows in the join are split by AQE.  The edge
list after each round is a written table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, store


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of ``(u, v)`` rows (u the centre): neighbours of u linked to its smallest one."""
    centre = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m"))
    joined = edges.join(centre, edges["u"] == centre["c"], "inner")
    if larger:                                   # v > u hangs on the minimum of u's neighbourhood
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:                                        # rows have v < u: v and u itself hang on the minimum
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            centre.select(F.col("c").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge, component = its smallest node.

    Null ends and loops are ignored; an empty edge list gives an empty result.
    """
    now = store(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "components")
    state = _digest(now)
    while state[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger=True)
        after = store(_star(large, larger=False), "components")
        free(now)
        now, previous, state = after, state, _digest(after)
        if state == previous:
            break
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return leaves.union(roots)
