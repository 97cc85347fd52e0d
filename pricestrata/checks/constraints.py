"""Row rules of every stored table and the cross-table rules for writing price facts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.operators.policy import eligible

Rules = list[tuple[str, Column]]
c = F.col


def one_of(name: str, values: tuple[str, ...]) -> tuple[str, Column]:
    return name, c(name).isin(*values)


def positive(name: str) -> tuple[str, Column]:
    return name, c(name).isNull() | (c(name) > 0)


def not_negative(name: str) -> tuple[str, Column]:
    return name, c(name) >= 0


def _quantity(prefix: str = "") -> Rules:
    value, low, high = (c(f"{prefix}quantity_{n}") for n in ("value", "min", "max"))
    return [
        positive(f"{prefix}quantity_value"),
        positive(f"{prefix}quantity_min"),
        positive(f"{prefix}quantity_max"),
        (f"{prefix}quantity_range_pair", low.isNull() == high.isNull()),
        (f"{prefix}quantity_exact_or_range", value.isNull() | (low.isNull() & high.isNull())),
        (f"{prefix}quantity_range_order", low.isNull() | (high >= low)),
    ]


def _unit(prefix: str, unit: str) -> Rules:
    value, low, high = (c(f"{prefix}quantity_{n}") for n in ("value", "min", "max"))
    none = value.isNull() & low.isNull() & high.isNull() & c(unit).isNull()
    some = (value.isNotNull() | low.isNotNull()) & c(unit).isNotNull()
    return [(f"{prefix}unit_semantics", none | some)]


def _quality_pair() -> tuple[str, Column]:
    accepted = c("quality_status") == "ACCEPTED"
    return "quality_semantics", (accepted & c("rejection_code").isNull()) | (
        ~accepted & c("rejection_code").isNotNull()
    )


def _national() -> tuple[str, Column]:
    return "national_region", (c("region_scope") != "NATIONAL") | (c("region_code") == "CN")


def _seen() -> tuple[str, Column]:
    return "observation_range", c("last_seen_at") >= c("first_seen_at")


def observation_checks() -> Rules:
    return [
        one_of("region_scope", vocab.REGION_SCOPES),
        ("single_region", c("region_scope") != "MULTI"),
        ("currency", c("currency") == "CNY"),
        one_of("original_price_type", vocab.ORIGINAL_TYPES),
        one_of("price_nature", vocab.PRICE_NATURES),
        one_of("price_type", vocab.PRICE_TYPES),
        one_of("pricing_basis", vocab.PRICING_BASES),
        one_of("availability", vocab.AVAILABILITIES),
        one_of("fee_status", vocab.FEE_STATUSES),
        one_of("quality_status", vocab.QUALITY),
        positive("original_price"),
        positive("current_price"),
        positive("unit_price"),
        (
            "original_price_semantics",
            (c("original_price").isNull() & (c("original_price_type") == "NONE"))
            | (c("original_price").isNotNull() & (c("original_price_type") != "NONE")),
        ),
        ("unit_price_semantics", c("unit_price").isNull() == c("unit_price_unit").isNull()),
        _quality_pair(),
        ("accepted_eligibility", (c("quality_status") != "ACCEPTED") | eligible()),
        _national(),
    ]


TABLE_RULES: dict[str, Callable[[], Rules]] = {
    "brand": lambda: [one_of("status", vocab.LIFECYCLES)],
    "category": lambda: [
        not_negative("level"),
        (
            "default_measure_type",
            c("default_measure_type").isNull() | c("default_measure_type").isin(*vocab.MEASURES),
        ),
    ],
    "item": lambda: [
        one_of("item_type", vocab.ITEM_TYPES),
        one_of("record_origin", vocab.RECORD_ORIGINS),
        one_of("status", vocab.ITEM_STATUSES),
    ],
    "variant": lambda: [
        one_of("condition_code", vocab.CONDITIONS),
        one_of("measure_type", vocab.MEASURES),
        one_of("status", vocab.ITEM_STATUSES),
        *_quantity(),
        positive("package_count"),
    ],
    "channel": lambda: [
        one_of("source_type", vocab.SOURCE_TYPES),
        one_of("business_mode", vocab.BUSINESS_MODES),
        one_of("access_mode", vocab.ACCESS_MODES),
        one_of("region_mode", vocab.REGION_MODES),
        ("currency", c("currency") == "CNY"),
    ],
    "merchant": lambda: [
        one_of("seller_type", vocab.SELLER_TYPES),
        one_of("verification_status", vocab.VERIFICATIONS),
        one_of("status", vocab.LIFECYCLES),
        _seen(),
    ],
    "listing": lambda: [
        one_of("price_nature", vocab.PRICE_NATURES),
        one_of("lifecycle_status", vocab.LIFECYCLES),
        not_negative("consecutive_misses"),
        _seen(),
    ],
    "run": lambda: [
        one_of("region_scope", vocab.REGION_SCOPES),
        one_of("run_type", vocab.RUN_TYPES),
        one_of("trigger_type", vocab.TRIGGERS),
        one_of("status", vocab.RUN_STATUSES),
        ("time_range", c("finished_at").isNull() | (c("finished_at") >= c("started_at"))),
        _national(),
        ("multi_region", (c("region_scope") != "MULTI") | (c("region_code") == "*")),
        *[
            not_negative(f"{n}_count")
            for n in ("discovered", "fetched", "accepted", "review", "rejected", "failed")
        ],
    ],
    "record": lambda: [
        one_of("entity_type", vocab.ENTITY_TYPES),
        one_of("fetch_method", vocab.FETCH_METHODS),
        one_of("fetch_status", vocab.OPERATION_STATUSES),
        one_of("parse_status", vocab.OPERATION_STATUSES),
        one_of("validation_status", vocab.OPERATION_STATUSES),
        ("raw_size", c("raw_size_bytes").isNull() | (c("raw_size_bytes") >= 0)),
        not_negative("duration_ms"),
        ("http_status", c("http_status").isNull() | c("http_status").between(100, 599)),
    ],
    "revision": lambda: [
        one_of("condition_code", vocab.CONDITIONS),
        one_of("measure_type", vocab.MEASURES),
        one_of("quality_status", vocab.QUALITY),
        ("revision_no", c("revision_no") > 0),
        *_quantity(),
        *_unit("", "quantity_unit"),
        *_quantity("base_"),
        *_unit("base_", "base_unit"),
        positive("package_count"),
        _quality_pair(),
        ("observation_range", c("last_observed_at") >= c("first_observed_at")),
    ],
    "match": lambda: [
        one_of("match_status", vocab.MATCH_STATUSES),
        one_of("match_method", vocab.MATCH_METHODS),
        ("confidence", c("confidence").between(0, 1)),
        (
            "effective_range",
            c("effective_to").isNull() | (c("effective_to") >= c("effective_from")),
        ),
    ],
    "observation": observation_checks,
    "current": lambda: [
        one_of("region_scope", vocab.REGION_SCOPES),
        ("known_region", ~c("region_scope").isin("UNKNOWN", "MULTI")),
        _national(),
    ],
}


def violations(df: DataFrame, table: str) -> DataFrame:
    """Adds the names of the broken rules of a table as an array.

    One projection per table, no shuffle; a rule that is unknown is not broken.
    """
    broken = [F.when(~rule, F.lit(name)) for name, rule in TABLE_RULES[table]()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def write_faults(
    facts: DataFrame,
    listings: DataFrame,
    merchants: DataFrame,
    revisions: DataFrame,
    records: DataFrame,
    runs: DataFrame,
) -> DataFrame:
    """First reason a fact may not be written, NULL when all its parents agree."""
    lst = listings.select(
        "listing_id",
        c("channel_id").alias("l_channel"),
        c("merchant_id").alias("l_merchant"),
        c("price_nature").alias("l_nature"),
    )
    mer = merchants.select(c("merchant_id").alias("l_merchant"), c("channel_id").alias("m_channel"))
    rev = revisions.select(
        "revision_id",
        c("listing_id").alias("r_listing"),
        c("quality_status").alias("r_quality"),
    )
    rec = records.select("record_id", "run_id", c("listing_id").alias("e_listing"))
    run = runs.select(
        "run_id",
        c("channel_id").alias("n_channel"),
        c("region_scope").alias("n_scope"),
        c("region_code").alias("n_code"),
    )
    joined = (
        facts.join(lst, "listing_id", "left")
        .join(mer, "l_merchant", "left")
        .join(rev, "revision_id", "left")
        .join(rec, "record_id", "left")
        .join(run, "run_id", "left")
    )
    elsewhere = (c("n_scope") != "MULTI") & (
        (c("n_scope") != c("region_scope")) | (c("n_code") != c("region_code"))
    )
    reason = (
        F.when(c("l_channel").isNull(), "LISTING_UNKNOWN")
        .when(~c("l_channel").eqNullSafe(c("m_channel")), "MERCHANT_OF_OTHER_CHANNEL")
        .when(
            c("r_listing").isNull()
            | (c("r_listing") != c("listing_id"))
            | (c("r_quality") != "ACCEPTED"),
            "REVISION_NOT_ACCEPTED_OF_LISTING",
        )
        .when(c("price_nature") != c("l_nature"), "PRICE_NATURE_DIFFERS")
        .when(c("n_channel").isNull(), "EVIDENCE_UNKNOWN")
        .when(c("e_listing") != c("listing_id"), "EVIDENCE_OF_OTHER_LISTING")
        .when(c("n_channel") != c("l_channel"), "EVIDENCE_OF_OTHER_CHANNEL")
        .when(elsewhere, "REGION_DIFFERS_FROM_RUN")
    )
    return joined.withColumn("write_fault", reason).select(*facts.columns, "write_fault")
