"""Connected components of an edge table by alternating large-star / small-star
rounds (Kiveris et al., "Connected Components in MapReduce and Beyond")."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def _mark(df: DataFrame):
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b")
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (a < b in every edge)."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(low, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionAll(low.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame, ws: Workspace, name: str = "cc") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    One row per node and round; a hub's edges are aggregated before they are
    shuffled and its join partition can be split.  Each round is a written table."""
    cur = ws.stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), f"{name}-0", free=False)
    mark, k = _mark(cur), 0
    while mark[0]:
        k += 1
        nxt = ws.stage(_small_star(_large_star(cur)), f"{name}-{k}", free=False)
        ws.drop(cur)
        cur, last, mark = nxt, mark, _mark(nxt)
        if mark == last:
            break
    return cur.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(
        cur.select("a", F.col("a")).distinct().toDF("node", "root"))
