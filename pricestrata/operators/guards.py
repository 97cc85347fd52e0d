"""Guards: large price changes, missing products, confirmed absence, stale runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.operators.ordered import newest, time_bucket, with_next, with_previous
from pricestrata.operators.quality import price_signatures

PRICE_KEY = ["listing_id", "identity_fingerprint", "region_scope", "region_code"]


def previous_trusted(facts: DataFrame, bucket: str = "DAY") -> DataFrame:
    """Accepted, priced facts with the trusted price before them.

    An availability-only fact in between does not reset the baseline.
    """
    priced = facts.where(
        (F.col("quality_status") == "ACCEPTED") & F.col("current_price").isNotNull()
    )
    return with_previous(
        priced,
        PRICE_KEY,
        ["observed_at", "ingest_seq"],
        F.struct(F.col("current_price").alias("price"), F.col("observed_at").alias("at")),
        time_bucket("observed_at", bucket),
        "previous",
    )


def large_changes(facts: DataFrame, threshold: str = "0.30", bucket: str = "DAY") -> DataFrame:
    """Flag prices strictly later than and more than ``threshold`` away from the one before."""
    gap = F.abs(F.col("current_price") - F.col("previous.price"))
    limit = F.lit(threshold).cast("decimal(6,4)") * F.col("previous.price")
    flag = (F.col("observed_at") > F.col("previous.at")) & (gap > limit)
    return previous_trusted(facts, bucket).withColumn(
        "needs_confirmation", F.coalesce(flag, F.lit(False))
    )


def confirm_changes(captures: DataFrame, rows: DataFrame, text: Column) -> DataFrame:
    """Two-capture confirmation per product.

    ``captures`` holds one row per (product_id, capture_seq) with needs_confirmation, complete
    and fetched_at; ``rows`` the accepted prices. A large change is trusted only when the next
    capture is later, both are complete and their signatures agree.
    """
    signed = captures.join(
        price_signatures(rows, ["product_id", "capture_seq"], text),
        ["product_id", "capture_seq"],
        "left",
    )
    value = F.struct(
        "capture_seq", "fetched_at", "complete", "signature_rows", "signature_a", "signature_b"
    )
    paired = with_next(
        signed, ["product_id"], ["capture_seq"], value, F.floor(F.col("capture_seq") / 10_000),
        "second",
    )
    agree = (
        (F.col("second.fetched_at") > F.col("fetched_at"))
        & F.col("complete")
        & F.col("second.complete")
        & F.col("second.signature_rows").eqNullSafe(F.col("signature_rows"))
        & F.col("second.signature_a").eqNullSafe(F.col("signature_a"))
        & F.col("second.signature_b").eqNullSafe(F.col("signature_b"))
    )
    verdict = (
        F.when(~F.col("needs_confirmation"), "TRUSTED")
        .when(F.coalesce(agree, F.lit(False)), "CONFIRMED")
        .otherwise("PRICE_CHANGE_UNCONFIRMED")
    )
    return paired.withColumn("verdict", verdict).withColumn(
        "confirmed_by", F.when(F.col("verdict") == "CONFIRMED", F.col("second.capture_seq"))
    ).drop("second")


def number_runs(runs: DataFrame) -> DataFrame:
    """Complete runs numbered per channel; a run table has one row per channel and batch."""
    order = Window.partitionBy("channel").orderBy("run_at")
    return runs.where("complete").withColumn("run_no", F.row_number().over(order))


def miss_streaks(runs: DataFrame, sightings: DataFrame, confirmation_runs: int) -> DataFrame:
    """Runs missed after every sighting, up to the next one.

    Gaps come from neighbouring sightings, so no product x run grid is ever built. A streak
    that reaches ``confirmation_runs`` makes the product a candidate for absence.
    """
    numbered = number_runs(runs).select("channel", "run_at", "run_no")
    last = numbered.groupBy("channel").agg(F.max("run_no").alias("last_no"))
    seen = (
        sightings.join(numbered, ["channel", "run_at"])
        .select("channel", "product_id", "run_no", "run_at")
        .distinct()
    )
    following = with_next(
        seen, ["channel", "product_id"], ["run_no"], F.col("run_no"),
        F.floor(F.col("run_no") / 10_000), "next_no",
    )
    misses = F.coalesce(F.col("next_no") - 1, F.col("last_no")) - F.col("run_no")
    return following.join(last, "channel").select(
        "channel",
        "product_id",
        F.col("run_at").alias("seen_at"),
        "run_no",
        misses.alias("misses"),
        F.col("next_no").isNull().alias("open"),
        (misses >= confirmation_runs).alias("candidate"),
    )


def confirmed_absences(streaks: DataFrame, records: DataFrame) -> DataFrame:
    """Open candidates whose own address answered 404 or 410 after their last sighting."""
    gone = records.where(
        F.col("http_status").isin(404, 410) & (F.col("request_url") == F.col("final_url"))
    )
    candidates = streaks.where("open AND candidate").select("product_id", "seen_at")
    later = candidates.join(gone, "product_id").where(F.col("fetched_at") > F.col("seen_at"))
    return newest(
        later.select("product_id", "record_id", "fetched_at", "source_hash"),
        ["product_id"],
        [-F.unix_micros(F.col("fetched_at").cast("timestamp"))],
    )


def absence_facts(absences: DataFrame, listings: DataFrame) -> DataFrame:
    """One AVAILABILITY_ONLY fact per known listing of an absent product; no amount is copied."""
    text = F.lit(None).cast("string")
    money = F.lit(None).cast("decimal(18,2)")
    return absences.join(listings, "product_id").select(
        "product_id", "listing_id", "revision_id", "record_id",
        F.lit("NATIONAL").alias("region_scope"),
        F.lit("CN").alias("region_code"),
        F.lit("RETAIL_OFFER").alias("price_nature"),
        F.lit("AVAILABILITY_ONLY").alias("price_type"),
        F.lit("UNKNOWN").alias("pricing_basis"),
        F.lit("NOT_APPLICABLE").alias("fee_status"),
        F.lit("OFF_SHELF").alias("availability"),
        F.lit("ACCEPTED").alias("quality_status"),
        money.alias("current_price"),
        money.alias("original_price"),
        text.alias("promotion_label"),
        "source_hash",
        F.col("fetched_at").alias("observed_at"),
        F.lit("INACTIVE").alias("lifecycle_status"),
    )


def recover_stale_runs(
    runs: DataFrame,
    now: Column,
    minutes: int,
    channel: Column,
    scope: list[str],
    region: tuple[str, str],
) -> DataFrame:
    """RUNNING runs of one channel, region and category set older than the limit become FAILED.

    All other runs keep their status, end and error code.
    """
    same_scope = F.array_sort(F.array_distinct("category_scope")) == F.array(
        *[F.lit(s) for s in sorted(set(scope))]
    )
    stale = (
        (F.col("status") == "RUNNING")
        & channel
        & same_scope
        & (F.col("region_scope") == region[0])
        & (F.col("region_code") == region[1])
        & (F.col("started_at") < now - F.expr(f"INTERVAL {minutes} MINUTE"))
    )
    return runs.withColumns(
        {
            "finished_at": F.when(stale, now).otherwise(F.col("finished_at")),
            "error_code": F.when(stale, "STALE_RUNNING_RECOVERED").otherwise(F.col("error_code")),
            "status": F.when(stale, "FAILED").otherwise(F.col("status")),
        }
    )
