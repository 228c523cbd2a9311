"""Connected components of an edge table, as jobs over edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import pin, unpin


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: link a node's larger neighbours to the smallest of it and its neighbours. Small star: link
    its smaller neighbours and itself to the smallest of them."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = around.join(least, "u")
    if large:
        made = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        made = linked.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        made = made.unionByName(least.where("u != m").select("u", F.col("m").alias("v")))
    return made.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, least): the smallest node reachable from each node of ``edges`` (u, v) that isn't smallest itself.

    Stars are alternately formed towards larger and smaller neighbours until nothing moves; every round is one
    table of at most as many edges as before, written and read again. Nodes with very many neighbours are only ever aggregated and joined by key."""
    now = pin(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    before = state(now)
    while before[0]:
        earlier, now = now, pin(_star(_star(now, True), False))
        unpin(earlier)
        after = state(now)
        if after == before:
            break
        before = after
    return now.groupBy("u").agg(F.min("v").alias("least")).withColumnRenamed("u", "node")
