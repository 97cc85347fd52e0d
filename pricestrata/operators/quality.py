"""Counts, completeness and status of captures and runs; duplicate and coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.functions.identity import multiset_signature
from pricestrata.operators.ordered import newest


def _row_summary(candidates: DataFrame, unit: list[str], row: str) -> DataFrame:
    """One row per source row: candidate counts per status and whether every region is covered."""
    accepted = F.col("quality_status") == "ACCEPTED"
    region = (
        candidates.groupBy(*unit, row, "region_scope", "region_code")
        .agg(
            F.first("identity_status").alias("identity_status"),
            F.count_if(accepted).alias("accepted"),
            F.count_if(F.col("quality_status") == "REVIEW_REQUIRED").alias("review"),
            F.count_if(F.col("quality_status") == "REJECTED").alias("rejected"),
        )
    )
    return region.groupBy(*unit, row).agg(
        F.first("identity_status").alias("identity_status"),
        F.sum("accepted").alias("accepted"),
        F.sum("review").alias("review"),
        F.sum("rejected").alias("rejected"),
        F.bool_and(F.col("accepted") > 0).alias("covered"),
    )


def unit_quality(candidates: DataFrame, unit: list[str], row: str) -> DataFrame:
    """Quality counts and completeness per unit.

    A row with an untrusted identity counts once; an accepted row counts its candidates. A unit
    is complete when every row is accepted and every region of the row has an accepted price.
    """
    trusted = F.col("identity_status") == "ACCEPTED"

    def total(name: str, status: str) -> Column:
        own = F.when(trusted, F.col(name)).otherwise(
            (F.col("identity_status") == status).cast("bigint")
        )
        return F.sum(own)

    return (
        _row_summary(candidates, unit, row)
        .groupBy(*unit)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            total("accepted", "ACCEPTED").alias("accepted_count"),
            total("review", "REVIEW_REQUIRED").alias("review_count"),
            total("rejected", "REJECTED").alias("rejected_count"),
            F.bool_and(trusted & F.col("covered")).alias("complete"),
        )
    )


def unit_status(candidates: DataFrame, unit: list[str], row: str, position: str) -> DataFrame:
    """SUCCEEDED, PARTIAL or FAILED with the first error code in row and candidate order."""
    identity = F.when(
        F.col("identity_code").isNotNull(),
        F.struct(F.col(row), F.lit(-1).cast("bigint").alias("p"), F.col("identity_code").alias("code")),
    )
    price = F.when(
        F.col("rejection_code").isNotNull(),
        F.struct(F.col(row), F.col(position).cast("bigint").alias("p"), F.col("rejection_code").alias("code")),
    )
    first = candidates.groupBy(*unit).agg(
        F.least(F.min(identity), F.min(price)).alias("first_error")
    )
    counted = unit_quality(candidates, unit, row).join(first, unit)
    return counted.withColumns(
        {
            "status": F.when(F.col("accepted_count") == 0, "FAILED")
            .when(F.col("complete"), "SUCCEEDED")
            .otherwise("PARTIAL"),
            "error_code": F.when(
                ~F.col("complete"),
                F.coalesce(F.col("first_error.code"), F.lit("NO_ACCEPTED_PRICE")),
            ),
        }
    ).drop("first_error")


def run_totals(units: DataFrame, run: list[str]) -> DataFrame:
    """Run counters, error histogram and final status from unit outcomes.

    The histogram is built from per-code counts, so its size is the number of codes.
    """
    by_code = units.groupBy(*run, "error_code").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in ("accepted_count", "review_count", "rejected_count")],
    )
    entry = F.when(F.col("error_code").isNotNull(), F.struct("error_code", "n"))
    totals = by_code.groupBy(*run).agg(
        F.sum("n").alias("discovered_count"),
        F.sum("accepted_count").alias("accepted_count"),
        F.sum("review_count").alias("review_count"),
        F.sum("rejected_count").alias("rejected_count"),
        F.array_sort(F.collect_list(entry)).alias("errors"),
    )
    return totals.withColumns(
        {
            "error_summary": F.map_from_entries("errors"),
            "status": F.when(F.col("accepted_count") == 0, "FAILED")
            .when(F.size("errors") > 0, "PARTIAL")
            .otherwise("SUCCEEDED"),
        }
    ).drop("errors")


def combined_status(runs: DataFrame, keys: list[str]) -> DataFrame:
    """All succeeded, some accepted, or failed."""
    return (
        runs.groupBy(*keys)
        .agg(
            F.bool_and(F.col("status") == "SUCCEEDED").alias("all_ok"),
            F.bool_or(F.col("accepted_count") != 0).alias("any_ok"),
            F.count(F.lit(1)).alias("runs"),
        )
        .select(
            *keys,
            "runs",
            F.when(F.col("all_ok"), "SUCCEEDED")
            .when(F.col("any_ok"), "PARTIAL")
            .otherwise("FAILED")
            .alias("status"),
        )
    )


def duplicate_identities(rows: DataFrame, batch: list[str], key: list[str]) -> DataFrame:
    """Batches with a repeated identity; one repeat spoils the whole batch."""
    return (
        rows.groupBy(*batch, *key)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*batch)
        .agg(
            F.sum("n").alias("rows"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
        )
        .withColumn("flagged", F.col("repeated_keys") > 0)
    )


def discovery_floor(
    found: DataFrame, known: DataFrame, scope: list[str], run: list[str], ratio: str
) -> DataFrame:
    """Runs that found fewer products than the floor max(1, ceil(known * ratio))."""
    size = known.groupBy(*scope).agg(F.count(F.lit(1)).alias("known_count"))
    counts = found.groupBy(*scope, *run).agg(F.count(F.lit(1)).alias("found_count"))
    floor = F.greatest(
        F.lit(1).cast("bigint"),
        F.ceil(F.col("known_count") * F.lit(ratio).cast("decimal(5,4)")).cast("bigint"),
    )
    return counts.join(size, scope).withColumn("floor_count", floor).withColumn(
        "below_floor", F.col("found_count") < F.col("floor_count")
    )


def known_listings(facts: DataFrame) -> DataFrame:
    """Distinct trusted (product, listing) rows with their last sighting: the set as rows."""
    return (
        facts.where(F.col("quality_status") == "ACCEPTED")
        .groupBy("product_id", "listing_id")
        .agg(F.max("observed_at").alias("last_seen_at"))
    )


def known_products(facts: DataFrame, context: Column) -> DataFrame:
    """Per product: size and signature of its listing set, last sighting, newest context."""
    trusted = facts.where(F.col("quality_status") == "ACCEPTED").withColumn("__ctx", context)
    listing = trusted.groupBy("product_id", "listing_id").agg(
        F.max("observed_at").alias("last_seen_at"),
        F.max(F.struct("observed_at", "ingest_seq", "__ctx")).alias("newest"),
    )
    return (
        listing.groupBy("product_id")
        .agg(
            *multiset_signature(F.col("listing_id")),
            F.max("last_seen_at").alias("last_seen_at"),
            F.max("newest").alias("newest"),
        )
        .withColumn("context", F.col("newest.__ctx"))
        .drop("newest")
    )


def latest_document(docs: DataFrame, source: list[str], date: str, url: str) -> DataFrame:
    """Newest dated document per source; two addresses for that date are ambiguous."""
    dated = docs.groupBy(*source, date, url).agg(F.count(F.lit(1)).alias("links"))
    per_date = dated.groupBy(*source, date).agg(
        F.count(F.lit(1)).alias("addresses"), F.min(url).alias(url)
    )
    return newest(per_date, source, [F.col(date)]).withColumn(
        "error_code", F.when(F.col("addresses") > 1, "DISCOVERY_AMBIGUOUS")
    )


def seen_range(rows: DataFrame, key: list[str], time: str) -> DataFrame:
    return rows.groupBy(*key).agg(
        F.min(time).alias("first_seen_at"), F.max(time).alias("last_seen_at")
    )


def merge_seen_range(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Ranges are associative: merging partial ranges equals recomputing them."""
    return old.unionByName(new).groupBy(*key).agg(
        F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")
    )


def market_groups(rows: DataFrame, doc: list[str]) -> DataFrame:
    """Rows of a market table grouped by market; faults reject the whole document.

    A region may appear once per market, so after that check the price list of a market is
    no longer than the region vocabulary.
    """
    cell = rows.groupBy(*doc, "market_id", "region_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("price").alias("price"),
        F.min("market_name").alias("low_name"),
        F.max("market_name").alias("high_name"),
    )
    markets = cell.groupBy(*doc, "market_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.bool_or(F.col("n") > 1) | (F.min("low_name") != F.max("high_name"))).alias("fault"),
        F.min("low_name").alias("market_name"),
        F.array_sort(F.collect_list(F.struct("region_code", "price"))).alias("prices"),
    )
    # One row per market of the document is left for this window.
    whole = F.bool_or("fault").over(Window.partitionBy(*doc))
    return markets.withColumn("fault", whole).where(~F.col("fault")).drop("fault")


def coverage(rows: DataFrame, key: list[str], price: str) -> DataFrame:
    return rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"), F.min(price).alias("min_price"), F.max(price).alias("max_price")
    )


def source_report(current: DataFrame, states: list[str]) -> DataFrame:
    """Current rows per source, those with an original price, and the availability spread."""
    return current.groupBy("channel").agg(
        F.count(F.lit(1)).alias("current_rows"),
        F.count("original_price").alias("with_original"),
        *[
            F.count_if(F.col("availability") == s).alias(f"state_{s.lower()}") for s in states
        ],
    )


def price_signatures(accepted: DataFrame, capture: list[str], text: Column) -> DataFrame:
    """Order-free signature of every trusted price of a capture; mergeable before the shuffle."""
    return accepted.groupBy(*capture).agg(*multiset_signature(text))


def merge_captures(responses: DataFrame, capture: list[str]) -> DataFrame:
    """Several responses of one product become one capture, one row per request.

    Each row carries the totals of its capture. Requests stay rows, however many there are.
    """
    totals = responses.groupBy(*capture).agg(
        F.count(F.lit(1)).alias("responses"),
        F.max("fetched_at").alias("fetched_at"),
        F.sum("duration_ms").alias("duration_ms"),
    )
    return responses.select(*capture, "request_no", "source_hash").join(totals, capture)


def advertised_fault(advertised: Column, limit: int) -> Column:
    """A product that advertises more SKUs than its source may is refused as a whole."""
    return F.when(F.size(advertised) > limit, "SKU_LIMIT_EXCEEDED")


def spread_distrust(rows: DataFrame, product: list[str]) -> DataFrame:
    """One untrusted identity sends every accepted candidate of its product to review."""
    bad = (
        rows.where(F.col("identity_status") != "ACCEPTED")
        .select(*product)
        .distinct()
        .withColumn("poisoned", F.lit(True))
    )
    hit = F.coalesce(F.col("poisoned"), F.lit(False)) & (F.col("quality_status") == "ACCEPTED")
    return (
        rows.join(bad, product, "left")
        .withColumn("rejection_code", F.when(hit, "PRODUCT_IDENTITY_UNTRUSTED").otherwise(F.col("rejection_code")))
        .withColumn("quality_status", F.when(hit, "REVIEW_REQUIRED").otherwise(F.col("quality_status")))
        .drop("poisoned")
    )


def lifecycle(facts: DataFrame, capture: list[str], time: str) -> DataFrame:
    """INACTIVE when every trusted candidate of the newest capture is off the shelf."""
    per_capture = (
        facts.where(F.col("quality_status") == "ACCEPTED")
        .groupBy("listing_id", *capture)
        .agg(
            F.bool_and(F.col("availability") == "OFF_SHELF").alias("gone"),
            F.max(time).alias("seen_at"),
        )
    )
    return newest(per_capture, ["listing_id"], [F.col("seen_at")]).select(
        "listing_id",
        "seen_at",
        F.when(F.col("gone"), "INACTIVE").otherwise("ACTIVE").alias("lifecycle_status"),
    )
