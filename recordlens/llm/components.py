"""Connected components by alternating stars, in joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

SALTS = 16       # parts that the edges of one node are split into
MOST_ROUNDS = 60


def _with_minimum(edges: DataFrame) -> DataFrame:
    """(u, v) edges with the smallest v of each u. Hubs are split: their minimum is repeated per salt."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "salt"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) of every node that has an edge to another.

    Each round links a node's larger neighbours, then its smaller ones, to its smallest; rounds grow with
    the logarithm of the longest chain. Edges with a NULL end and loops are left out. Nothing but a
    checksum per round reaches the driver.
    """
    start = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    current = stage(start.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "edges")
    check = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
    seen = check(current)
    for _ in range(MOST_ROUNDS):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = F.least("u", "m")
        large = _with_minimum(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), m.alias("v")).distinct()
        linked = _with_minimum(large)
        small = linked.select("u", F.col("m").alias("v")).unionByName(
            linked.filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        current = stage(small, "edges")
        now = check(current)
        if now == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = now
    raise RuntimeError("components did not settle")
