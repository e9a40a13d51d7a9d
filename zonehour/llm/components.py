"""Connected components of an edge list, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonehour.llm.common import stored

SALTS = 16  # tasks that share the edges of one node in a join


def toward_least(pairs: DataFrame) -> DataFrame:
    """u, v and m, the least of u and all its v, for directed pairs (u, v).
    The edges of a hot u are dealt to SALTS tasks."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"]).select("u", "v", "m")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node and component (its least node) of every node of ``edges`` (u, v as
    bigint). Loops, repeated edges and either direction may occur; no edges
    give no rows.

    A large star links a node's larger neighbours to its least one, a small
    star its smaller ones; both keep the components. When a round changes
    nothing, every node is linked to its least.
    """
    nodes = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now = stored(nodes, "components")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components")
        found = toward_least(large)
        small = found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(found.select("u", F.col("m").alias("v")))
        now = stored(small.where("u <> v").distinct(), "components")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
