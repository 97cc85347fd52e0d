"""Dimension merges: get-or-create with conflict detection, and time-guarded upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.operators.facts import first_arrivals
from pricestrata.operators.ordered import running


def merge_dimension(
    existing: DataFrame, incoming: DataFrame, key: list[str], identity: list[str]
) -> DataFrame:
    """One row per key with outcome NEW, SAME, CONFLICT or KEPT.

    Rows that disagree about an identity column inside the batch, or with the stored row, are
    conflicts; the batch shrinks to one row per key before it meets the store.
    """
    packed = F.struct(*identity)
    batch = incoming.groupBy(*key).agg(F.min(packed).alias("low"), F.max(packed).alias("high"))
    stored = existing.select(*key, F.struct(*identity).alias("stored"))
    torn = F.col("low").isNotNull() & ~F.col("low").eqNullSafe(F.col("high"))
    outcome = (
        F.when(F.col("low").isNull(), "KEPT")
        .when(torn, "CONFLICT")
        .when(F.col("stored").isNull(), "NEW")
        .when(F.col("stored").eqNullSafe(F.col("low")), "SAME")
        .otherwise("CONFLICT")
    )
    value = F.coalesce(F.col("stored"), F.col("low"))
    return batch.join(stored, key, "full_outer").select(
        *key, *[value[n].alias(n) for n in identity], outcome.alias("outcome")
    )


def upsert_by_time(
    rows: DataFrame,
    key: list[str],
    mutable: list[str],
    sticky: list[str],
    time: str = "observed_at",
    trusted: str = "trusted",
    chunk: int = 1_000_000,
) -> DataFrame:
    """Replay arrivals: the first creates a row, later trusted ones refresh it when strictly newer.

    ``rows`` is the stored row (arrival first) plus the batch, ordered by ingest_seq. Mutable
    fields come from the newest applied arrival; sticky ones keep their last non-NULL value;
    the seen range covers the first arrival and every trusted one.
    """
    first = first_arrivals(rows, key).select(*key, F.col("ingest_seq").alias("__first"))
    counted = rows.join(first, key).where(
        F.col(trusted) | (F.col("ingest_seq") == F.col("__first"))
    )
    applied = F.col("__seen").isNull() | (F.col(time) > F.col("__seen"))
    judged = running(
        counted, key, ["ingest_seq"], F.col(time), F.floor(F.col("ingest_seq") / chunk), "__seen",
        how="max", inclusive=False,
    ).withColumn("__applied", applied)
    order = F.col(time)
    return judged.groupBy(*key).agg(
        *[F.max_by(n, F.when(F.col("__applied"), order)).alias(n) for n in mutable],
        *[
            F.max_by(n, F.when(F.col("__applied") & F.col(n).isNotNull(), order)).alias(n)
            for n in sticky
        ],
        F.min(time).alias("first_seen_at"),
        F.max(time).alias("last_seen_at"),
    )
