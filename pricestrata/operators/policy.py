"""Price gate and accepted-fact eligibility."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.device import ordered_case
from pricestrata.functions.money import unit_price

POLICY_VERSION = "catalog-price-policy-1"

PricePolicy = Callable[..., DataFrame]


def default_region(df: DataFrame, scope: str | None = None, code: str | None = None) -> DataFrame:
    """Candidate region, else the request's, else UNKNOWN."""
    known = F.col("region_scope").isNotNull()
    return df.withColumns(
        {
            "region_code": F.when(known, F.col("region_code")).otherwise(F.lit(code or "UNKNOWN")),
            "region_scope": F.coalesce(F.col("region_scope"), F.lit(scope or "UNKNOWN")),
        }
    )


def derive_unit_price(df: DataFrame) -> DataFrame:
    """Adds the derived price per base unit and fills it in where the source gave none.

    The flags keep the division out of every NULL test, so that a filter on the verdict that
    the optimizer pushes below this step stays small.
    """
    c = F.col
    unit = F.concat(F.lit("CNY_PER_"), c("base_unit"))
    return (
        df.withColumnRenamed("unit_price", "source_unit_price")
        .withColumnRenamed("unit_price_unit", "source_unit")
        .withColumn(
            "derivable",
            c("pricing_basis").isin(*vocab.EXACT_BASES)
            & c("current_price").isNotNull()
            & c("base_quantity_value").isNotNull()
            & c("base_unit").isNotNull(),
        )
        .withColumn("fitting", c("derivable") & (F.length(unit) <= 16))
        .withColumns(
            {
                "has_unit_price": c("source_unit_price").isNotNull() | c("fitting"),
                "has_unit": F.when(c("source_unit_price").isNotNull(), c("source_unit").isNotNull())
                .otherwise(c("fitting") | c("source_unit").isNotNull()),
                "unit_price": F.when(
                    c("source_unit_price").isNotNull(),
                    c("source_unit_price").cast("decimal(20,6)"),
                ).when(c("fitting"), _derived()),
                "unit_price_unit": F.when(
                    c("source_unit_price").isNull() & c("fitting"), unit
                ).otherwise(c("source_unit")),
            }
        )
    )


def _derived() -> Column:
    return unit_price(F.col("current_price"), F.col("base_quantity_value"))


def _reason() -> Column:
    c = F.col
    silent = c("price_type") == "AVAILABILITY_ONLY"
    priced = ~silent
    offer = c("price_nature").isin(*vocab.OFFER_NATURES)
    average = c("price_nature").isin(*vocab.AVERAGE_NATURES)
    amounts = (
        c("current_price").isNotNull()
        | c("original_price").isNotNull()
        | c("has_unit_price")
        | c("has_unit")
    )
    terms = (
        (c("pricing_basis") != "UNKNOWN")
        | (c("fee_status") != "NOT_APPLICABLE")
        | c("promotion_label").isNotNull()
    )
    other_unit = ~F.concat(F.lit("CNY_PER_"), c("base_unit")).eqNullSafe(c("source_unit"))
    unit_conflict = (
        c("source_unit_price").isNotNull()
        & c("derivable")
        & ((c("fitting") & other_unit) | (F.round(c("source_unit_price"), 6) != _derived()))
    )
    below = (
        (c("price_nature") == "RETAIL_OFFER") & (c("original_price") < c("current_price"))
    )
    none = F.lit(None).cast("string")
    rules = [
        (c("source_rejection").isNotNull(), c("source_rejection")),
        (silent & (c("region_scope") == "UNKNOWN"), "REGION_UNKNOWN"),
        (silent & (c("price_nature") != "RETAIL_OFFER"), "AVAILABILITY_NATURE_UNTRUSTED"),
        (silent & ~c("availability").isin(*vocab.NON_SELLING), "AVAILABILITY_STATE_UNTRUSTED"),
        (silent & amounts, "AVAILABILITY_AMOUNT_PRESENT"),
        (silent & terms, "AVAILABILITY_PRICING_TERMS_PRESENT"),
        (silent, none),
        (c("current_price").isNull(), "CURRENT_PRICE_MISSING"),
        (c("region_scope") == "UNKNOWN", "REGION_UNKNOWN"),
        (c("price_nature") == "UNKNOWN", "PRICE_NATURE_UNKNOWN"),
        (~c("pricing_basis").isin(*vocab.EXACT_BASES), "PRICING_BASIS_UNTRUSTED"),
        (
            (c("pricing_basis") == "UNIT_QUOTED") & ~c("has_unit_price"),
            "UNIT_PRICE_MISSING",
        ),
        (unit_conflict, "UNIT_PRICE_MISMATCH"),
        (offer & (c("price_type") != "DIRECT_UNCONDITIONAL"), "CONDITIONAL_PRICE"),
        (offer & ~c("fee_status").isin(*vocab.ITEM_FEES), "FEE_SEMANTICS_UNTRUSTED"),
        (F.coalesce(below, F.lit(False)), "ORIGINAL_BELOW_CURRENT"),
        (average & (c("price_type") != "PUBLISHED_VALUE"), "MARKET_VALUE_UNPUBLISHED"),
        (average & (c("fee_status") != "NOT_APPLICABLE"), "MARKET_FEE_SEMANTICS_INVALID"),
    ]
    return ordered_case(rules, none)


def gate(df: DataFrame, scope: str | None = None, code: str | None = None) -> DataFrame:
    """ACCEPTED or REJECTED with the first reason; a source-supplied reason beats all."""
    renamed = df.withColumnRenamed("rejection_code", "source_rejection")
    judged = derive_unit_price(default_region(renamed, scope, code)).withColumn(
        "rejection_code", _reason()
    )
    status = F.when(F.col("rejection_code").isNull(), "ACCEPTED").otherwise("REJECTED")
    return judged.withColumn("quality_status", status).drop(
        "source_rejection", "source_unit_price", "source_unit", "derivable", "fitting",
        "has_unit_price", "has_unit",
    )


def eligible() -> Column:
    """What an accepted fact must look like: a silent state or a fully stated price."""
    c = F.col
    silent = (
        (c("price_type") == "AVAILABILITY_ONLY")
        & (c("price_nature") == "RETAIL_OFFER")
        & (c("region_scope") != "UNKNOWN")
        & c("availability").isin(*vocab.NON_SELLING)
        & c("current_price").isNull()
        & c("original_price").isNull()
        & (c("original_price_type") == "NONE")
        & c("unit_price").isNull()
        & c("unit_price_unit").isNull()
        & (c("pricing_basis") == "UNKNOWN")
        & (c("fee_status") == "NOT_APPLICABLE")
        & c("promotion_label").isNull()
    )
    offer = (
        c("price_nature").isin(*vocab.OFFER_NATURES)
        & (c("price_type") == "DIRECT_UNCONDITIONAL")
        & c("fee_status").isin(*vocab.ITEM_FEES)
    )
    average = (
        c("price_nature").isin(*vocab.AVERAGE_NATURES)
        & (c("price_type") == "PUBLISHED_VALUE")
        & (c("fee_status") == "NOT_APPLICABLE")
    )
    priced = (
        c("current_price").isNotNull()
        & (c("region_scope") != "UNKNOWN")
        & (c("price_nature") != "UNKNOWN")
        & c("pricing_basis").isin(*vocab.EXACT_BASES)
        & ((c("pricing_basis") != "UNIT_QUOTED") | c("unit_price").isNotNull())
        & (offer | average)
    )
    return silent | priced


POLICIES: dict[str, PricePolicy] = {POLICY_VERSION: gate}


def register_policy(version: str, policy: PricePolicy) -> None:
    """Add a price policy; its version becomes part of every observation key it produces."""
    if not version.strip() or version in POLICIES:
        raise ValueError(f"policy version is blank or already registered: {version!r}")
    POLICIES[version] = policy


def evaluate(df: DataFrame, version: str = POLICY_VERSION, **scope: str) -> DataFrame:
    if version not in POLICIES:
        raise ValueError(f"unknown price policy: {version!r}")
    return POLICIES[version](df, **scope).withColumn("policy_version", F.lit(version))
