"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31)), F.sum("v")).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is named by its least node.

    Each round writes its edges, so lost executors cost one round at most and the plan stays
    short. Least neighbours are aggregates, combined before the shuffle and dealt out anew
    before the join (``rebalance``), so that AQE can split the edges of a hub.
    """
    now = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct()
    )
    now = texts.stored(now, "components")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("m", "u").alias("m")).hint("rebalance")
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m")).hint("rebalance")
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = texts.stored(small, "components")
        before, state = state, _state(now)
        if state == before:
            break
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
