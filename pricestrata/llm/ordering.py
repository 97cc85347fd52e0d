"""Positions of rows in an order, without one task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.llm import texts


def numbered(rows: DataFrame, group: list[str], order: list[str], out: str = "number") -> DataFrame:
    """``rows``, stored, with their place (from 0) in their group, nulls first; rows that are equal
    in all of these columns get places of their own.

    Rows are dealt out by ranges of (group, order) and sorted there. A place is the place in
    its range plus the rows of the group in the ranges before it: one summary row per group
    and range, so a group that holds a third of all rows lies in many tasks. The last key of a range tells equal rows
    apart, so that these are divided too; which of them gets which place does not show.
    """
    names = rows.columns
    keys = [F.asc_nulls_first(c) for c in (*group, *order)]
    tie = texts.free_name(rows, "_tie")
    placed = rows.withColumn(tie, F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*keys, F.col(tie)).sortWithinPartitions(*keys).drop(tie)
    # In a sorted partition this id is: partition number, then place.
    placed = texts.stored(placed.withColumn("_at", F.monotonically_increasing_id()), "ordered")
    placed = placed.select(
        *names, F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    ranges = ranges.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    ranges = ranges.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)), F.col("_part").alias("_p"), "_base")
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(ranges.hint("rebalance"), same).select(
        *names, (F.col("_base") + F.col("_place")).alias(out)
    )
