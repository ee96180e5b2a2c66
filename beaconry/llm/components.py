"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.session import materialize


def _nearest(edges: DataFrame) -> DataFrame:
    """Per node the smallest node among itself and its neighbours."""
    return edges.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows ``(a, b)``: every linked node but the smallest of its component, with that smallest node.

    ``edges`` has longs ``a, b``. Each round points the larger neighbours of a node, then the node and its smaller
    neighbours, at the smallest neighbour, until nothing changes; that takes a number of rounds logarithmic in the
    size of the largest component. Every round is a written table, so no round depends on an executor that is gone,
    and minima are joined from written tables, so Spark can split a node with very many neighbours.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "links")
    seen = _signature(edges)
    if not seen[0]:
        return edges
    for _ in range(rounds):
        both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links-both")
        near = materialize(_nearest(both), "links-near")
        large = materialize(both.join(near, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .filter("a <> b").distinct(), "links-large")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        near = materialize(_nearest(down), "links-near")
        small = down.join(near, "a").select(F.explode(F.array(
            F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e")).select(
                F.col("e.b").alias("a"), F.col("e.m").alias("b"))
        edges = materialize(small.filter("a <> b").distinct(), "links")
        now = _signature(edges)
        if now == seen:
            return edges
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
