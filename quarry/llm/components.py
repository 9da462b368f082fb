"""Connected components by alternating large-star and small-star rounds.

Each round is two equi-joins on node ids and an aggregate with map-side
combine; no neighbour list is ever gathered, so a hub with a third of all
edges only makes one skewed join side, which AQE splits.  Every round is
written to the shared folder.  The number of rounds grows with the logarithm
of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged


def _min_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    sym = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = _min_of(sym).select("a", F.least("a", "m").alias("m"))
    up = sym.where("b > a").join(m, "a")
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    m = _min_of(down)
    side = down.join(m, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return side.unionByName(m.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``edges(a, b)`` of long ids -> ``(node, component)``, the component
    being its smallest node.  Nodes without an edge are not listed.  Rows
    with a null end and self-loops are ignored."""
    e = staged(edges.select("a", "b").where("a <> b"), name)
    seen = None
    while True:
        e = staged(_small_star(_large_star(e)), name)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
