"""Scope, trust and evidence gates: flag columns with the first reason against a row."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col

# First bytes of an OLE2 workbook (fixed value).
WORKBOOK_MAGIC = "D0CF11E0A1B11AE1"
# Content types each kind of document may carry (fixed values); empty means undeclared.
CONTENT_TYPES = {
    "HTML": ("text/html", "application/xhtml+xml", ""),
    "WORKBOOK": ("application/vnd.ms-excel", "application/octet-stream", ""),
}


@dataclass(frozen=True)
class Scope:
    """What a collection run asked for."""

    region_scope: str
    region_code: str
    categories: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        if self.region_scope == "NATIONAL" and self.region_code != "CN":
            raise ValueError("NATIONAL scope needs region code CN")
        if (self.region_scope == "MULTI") != (self.region_code == "*"):
            raise ValueError("MULTI scope and region code * go together")


def scope_reason(scope: Scope) -> Column:
    """Category asked for, and region equal to the request unless it spans many regions."""
    outside = (
        ~c("category_code").isin(*[x.strip().upper() for x in scope.categories])
        if scope.categories
        else F.lit(False)
    )
    elsewhere = (
        F.lit(False)
        if scope.region_scope == "MULTI"
        else ~(
            c("region_scope").eqNullSafe(F.lit(scope.region_scope))
            & c("region_code").eqNullSafe(F.lit(scope.region_code))
        )
    )
    return F.when(outside, "CATEGORY_OUT_OF_SCOPE").when(elsewhere, "REGION_OUT_OF_SCOPE")


def trust_reason(expected_brand: Column) -> Column:
    """Device rows come from the verified brand seller and share their capture's time and hash."""
    seller = (
        (c("price_nature") == "RETAIL_OFFER")
        & (c("seller_type") == "BRAND_OFFICIAL")
        & (c("verification_status") == "VERIFIED")
    )
    override = c("source_observed_at").isNotNull() | c("evidence_hash").isNotNull()
    return (
        F.when(~c("brand_code").eqNullSafe(F.upper(F.trim(expected_brand))), "PRODUCT_BRAND_MISMATCH")
        .when(~F.coalesce(seller, F.lit(False)), "SELLER_UNTRUSTED")
        .when(override, "DEVICE_EVIDENCE_OVERRIDE")
    )


def evidence_reason(kind: str, top_status: int = 399) -> Column:
    """Response status, content type, workbook magic, agreeing dates, and no date in the future."""
    wrong_type = ~c("content_type").isin(*CONTENT_TYPES[kind])
    checks = F.when(~c("http_status").between(200, top_status), "HTTP_STATUS")
    if kind == "WORKBOOK":
        checks = checks.when(
            ~F.coalesce(F.upper(c("head_hex")).startswith(WORKBOOK_MAGIC), F.lit(False)),
            "ATTACHMENT_INVALID",
        ).when(wrong_type, "ATTACHMENT_INVALID")
    else:
        checks = checks.when(wrong_type, "CONTENT_TYPE")
    late = c("source_observed_at") > c("fetched_at") + F.expr("INTERVAL 5 MINUTE")
    return (
        checks.when(c("found_date").isNull(), "SOURCE_DATE_INVALID")
        .when(c("found_date") != c("expected_date"), "SOURCE_DATE_MISMATCH")
        .when(late, "SOURCE_DATE_MISMATCH")
    )


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reason", reason)
