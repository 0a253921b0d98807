"""Connected components over an edge table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component = smallest node reachable.

    Each round is one large-star and one small-star step: every neighbour of a
    node is linked to the node's smallest neighbour. Steps are group-by minima
    joined back, so a hub is never collected; the edge table is written to the
    shared folder after each round. Loops and repeated edges are allowed; edges
    with a null end are ignored. An empty table gives no rows.
    """
    cur = edges.select("a", "b").where("a is not null and b is not null and a <> b")
    cur = cur.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = materialise(cur, "edges")
    before = _signature(cur)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        cur = materialise(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        now = _signature(cur)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
