"""Ordered per-key computations that survive a key holding a third of all rows.

A plain window puts one key into one task. Here the order axis is cut into buckets (a time
slice): rows are processed inside (key, bucket), every bucket is reduced to one summary row
before it is shuffled, and only those summaries are ordered per key. The bucket width is the
caller's knob; a (key, bucket) group is the largest unit one task sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "__bucket"


def _with_bucket(df: DataFrame, bucket: Column) -> DataFrame:
    return df.withColumn(_B, bucket)


def _carried(base: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Join bucket summaries back to their rows; a NULL key or bucket meets its own summary."""
    named = carry.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate([*keys, _B])], "__carry"
    )
    same = F.lit(True)
    for i, k in enumerate([*keys, _B]):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return base.join(named, same, "left")


def time_bucket(column: str, unit: str = "DAY") -> Column:
    return F.date_trunc(unit, F.col(column)).cast("timestamp_ntz")


def newest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the greatest by ``order``; combines before the shuffle."""
    names = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*names), F.struct(*order)).alias("best"))
        .select(*keys, *[F.col("best")[n].alias(n) for n in names])
        .select(*df.columns)
    )


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    bucket: Column,
    out: str,
) -> DataFrame:
    """Adds ``out`` = ``value`` of the row before this one; ``value`` must not be NULL."""
    base = _with_bucket(df, bucket).withColumn("__v", value)
    inside = Window.partitionBy(*keys, _B).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(_B)
    tails = (
        base.groupBy(*keys, _B)
        .agg(F.max(F.struct(F.struct(*order).alias("o"), F.col("__v").alias("v"))).alias("t"))
        .withColumn("__carry", F.lag("t.v").over(across))
        .drop("t")
    )
    return (
        _carried(base.withColumn("__in", F.lag("__v").over(inside)), tails, keys)
        .select(*df.columns, F.coalesce(F.col("__in"), F.col("__carry")).alias(out))
    )


def with_next(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    bucket: Column,
    out: str,
) -> DataFrame:
    """Adds ``out`` = ``value`` of the row after this one; ``value`` must not be NULL."""
    base = _with_bucket(df, bucket).withColumn("__v", value)
    inside = Window.partitionBy(*keys, _B).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(_B)
    heads = (
        base.groupBy(*keys, _B)
        .agg(F.min(F.struct(F.struct(*order).alias("o"), F.col("__v").alias("v"))).alias("t"))
        .withColumn("__carry", F.lead("t.v").over(across))
        .drop("t")
    )
    return (
        _carried(base.withColumn("__in", F.lead("__v").over(inside)), heads, keys)
        .select(*df.columns, F.coalesce(F.col("__in"), F.col("__carry")).alias(out))
    )


def carry_forward(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    bucket: Column,
    out: str,
) -> DataFrame:
    """Adds ``out`` = last non-NULL ``value`` at or before this row."""
    base = _with_bucket(df, bucket).withColumn("__v", value)
    inside = (
        Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    across = (
        Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    )
    has = F.col("__v").isNotNull()
    tails = (
        base.groupBy(*keys, _B)
        .agg(
            F.max(
                F.when(has, F.struct(F.struct(*order).alias("o"), F.col("__v").alias("v")))
            ).alias("t")
        )
        .withColumn("__carry", F.last(F.col("t.v"), ignorenulls=True).over(across))
        .drop("t")
    )
    return (
        _carried(base.withColumn("__in", F.last("__v", ignorenulls=True).over(inside)), tails, keys)
        .select(*df.columns, F.coalesce(F.col("__in"), F.col("__carry")).alias(out))
    )


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    bucket: Column,
    out: str,
    how: str = "sum",
    inclusive: bool = True,
) -> DataFrame:
    """Adds ``out`` = running sum or max of ``value``, with or without this row itself."""
    combine = {"sum": F.sum, "max": F.max}[how]
    base = _with_bucket(df, bucket).withColumn("__v", value)
    rows = Window.unboundedPreceding, 0 if inclusive else -1
    inside = Window.partitionBy(*keys, _B).orderBy(*order).rowsBetween(*rows)
    across = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        base.groupBy(*keys, _B)
        .agg(combine("__v").alias("t"))
        .withColumn("__carry", combine("t").over(across))
        .drop("t")
    )
    both = F.col("__in"), F.col("__carry")
    if how == "max":
        merged = F.greatest(*both)
    else:
        zero = F.lit(0)
        merged = F.coalesce(both[0], zero) + F.coalesce(both[1], zero)
    return (
        _carried(base.withColumn("__in", combine("__v").over(inside)), totals, keys)
        .select(*df.columns, merged.alias(out))
    )
