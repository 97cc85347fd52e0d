"""Batch jobs: evidence rows to dimensions, revisions, facts and pointers, all sources at once.

``prepare_*`` is one pass over the evidence. A production job writes its result (see
``settle``) and derives every output from the written table, so that evidence is parsed once
and a lost executor recomputes a table read, not the parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions.identity import json_hash, sha256
from pricestrata.operators import facts as fact_ops
from pricestrata.operators import rules
from pricestrata.operators.policy import evaluate
from pricestrata.operators.quality import spread_distrust
from pricestrata.session import settle
from pricestrata.sources import malls
from pricestrata.sources.pages import market_candidates, market_rows
from pricestrata.sources.seeds import commodities

c = F.col
# Source constants of the wholesale table (fixed values).
MARKET_UNIT = "元/公斤"
MARKET_SPECIFICATION = "批发市场当日报价"
MARKET_CHANNEL = "MOFCOM_FRESH_WHOLESALE"
MARKET_CATEGORY = "FRESH_MONITORED_COMMODITY"


def arrival(doc_id: Column, row_no: Column) -> Column:
    """One number in the order (document, row). Rows of a page beyond 2**20 are an error."""
    fits = (row_no >= 0) & (row_no < 1 << 20)
    number = F.shiftleft(doc_id.cast("bigint"), 20) + row_no
    return F.when(fits, number).otherwise(F.raise_error(F.lit("row number out of range")).cast("bigint"))


def market_listings(docs: DataFrame) -> DataFrame:
    """Wholesale pages as listing rows with identity, merchant and price evidence."""
    names = F.broadcast(commodities(docs.sparkSession))
    rows = market_candidates(market_rows(docs)).join(names, "commodity_id")
    listing_key = F.concat(
        F.lit("mofcom-bj:"), c("commodity_id"), F.lit(":market:"), c("market_id"), F.lit(":unit:kg")
    )
    attributes = F.create_map(
        F.lit("commodity_code"), c("commodity_code"),
        F.lit("commodity_name"), c("commodity_name"),
        F.lit("commodity_group"), c("commodity_group"),
        F.lit("source_specification"), F.lit(MARKET_SPECIFICATION),
        F.lit("quoted_unit"), F.lit(MARKET_UNIT),
        F.lit("net_content"), F.lit("1公斤"),
        F.lit("source_market_id"), c("market_id"),
    )
    evidence_hash = json_hash(
        F.lit(MARKET_CHANNEL), c("source_date").cast("string"), c("commodity_id"),
        c("commodity_name"), F.lit(MARKET_UNIT), c("market_id"), c("market_name"),
        c("region_code"), c("price_text"),
    )
    none = F.lit(None).cast("string")
    return rows.select(
        c("doc_id").alias("record_id"),
        arrival(c("doc_id"), c("row_no")).alias("ingest_seq"),
        F.lit(MARKET_CHANNEL).alias("channel"),
        F.concat(F.lit("mofcom-bj-market:"), c("market_id")).alias("merchant_key"),
        "market_name",
        listing_key.alias("listing_key"),
        F.lit(MARKET_CATEGORY).alias("category_code"),
        attributes.alias("source_attributes"),
        F.lit("PROVINCE").alias("region_scope"),
        "region_code",
        F.lit("CNY").alias("currency"),
        F.lit("WHOLESALE_AVERAGE").alias("price_nature"),
        c("price").alias("current_price"),
        F.lit(None).cast("decimal(18,2)").alias("original_price"),
        F.lit("NONE").alias("original_price_type"),
        F.lit("PUBLISHED_VALUE").alias("price_type"),
        F.lit("UNIT_QUOTED").alias("pricing_basis"),
        F.lit("UNKNOWN").alias("availability"),
        F.lit("NOT_APPLICABLE").alias("fee_status"),
        none.alias("promotion_label"),
        F.concat(c("price_text"), F.lit(MARKET_UNIT)).alias("displayed_price_text"),
        F.lit(None).cast("decimal(20,6)").alias("unit_price"),
        none.alias("unit_price_unit"),
        none.alias("rejection_code"),
        evidence_hash.alias("source_hash"),
        "observed_at",
    )


def judge_documents(rows: DataFrame) -> DataFrame:
    """Identity by category rule, fingerprint, listing and revision keys, then the price gate."""
    routed = rules.dispatch(rows).where(c("dispatch_error").isNull())
    identified = rules.with_fingerprint(rules.fresh_identity(routed, c("profile")))
    keyed = identified.withColumn(
        "listing_id", sha256(F.concat_ws("|", "channel", "merchant_key", "listing_key"))
    ).withColumn("revision_id", sha256(F.concat_ws("|", "listing_id", "identity_fingerprint")))
    return evaluate(keyed)


def judge_products(rows: DataFrame) -> DataFrame:
    """Device rows: identity, gate, then one untrusted SKU holds back its whole product."""
    return spread_distrust(evaluate(rules.device_identity(rows)), ["channel", "external_product_id"])


def judged_rows(channel: str, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(judged listing rows, failed documents with their ``doc_error``) of one source.

    Parsed rows and judged rows are written, so that each is computed once.
    """
    rows = settle(parse(channel, docs), "parsed")
    failed = rows.where(c("doc_error").isNotNull()).select("record_id", "doc_error")
    good = rows.where(c("doc_error").isNull()).drop("doc_error")
    if channel not in malls.MALLS:
        return settle(judge_documents(good), "judged"), failed
    judged = settle(judge_products(good), "judged")
    spec = sha256(F.coalesce("identity_json", F.lit("")))
    keyed = judged.withColumn(
        "listing_id", sha256(F.concat_ws("|", "channel", "merchant_key", "listing_key"))
    ).withColumn("identity_fingerprint", spec)
    return keyed.withColumn(
        "revision_id", sha256(F.concat_ws("|", "listing_id", "identity_fingerprint"))
    ), failed


def document_facts(judged: DataFrame, adapter_version: str) -> DataFrame:
    """Facts of accepted identities; same-time publications become correction chains.

    The link is made on the key without a link (base key), so keys never depend on each other.
    """
    trusted = judged.where(c("identity_status") == "ACCEPTED")
    keyed = fact_ops.with_keys(trusted, adapter_version).withColumn("base_key", c("observation_key"))
    accepted = fact_ops.correction_chain(keyed.where(c("quality_status") == "ACCEPTED"))
    others = fact_ops.first_arrivals(
        keyed.where(c("quality_status") != "ACCEPTED"), ["observation_key"]
    ).withColumn("supersedes_key", F.lit(None).cast("string"))
    linked = accepted.unionByName(others)
    return fact_ops.with_keys(linked, adapter_version, c("supersedes_key"))


def outputs(judged: DataFrame, adapter_version: str) -> dict[str, DataFrame]:
    """Every table the batch changes, derived from the prepared rows."""
    facts = document_facts(judged, adapter_version)
    trusted = (c("identity_status") == "ACCEPTED") & (c("quality_status") == "ACCEPTED")
    seen = [F.min("observed_at").alias("first_seen_at"), F.max("observed_at").alias("last_seen_at")]
    return {
        "merchant": judged.where(trusted)
        .groupBy("channel", "merchant_key")
        .agg(F.max_by("market_name", "observed_at").alias("name"), *seen),
        "listing": judged.where(trusted)
        .groupBy("listing_id", "channel", "merchant_key", "listing_key")
        .agg(*seen),
        "revision": fact_ops.revision_numbers(judged),
        "observation": facts,
        "current": fact_ops.rebuild_current(facts),
        "review": judged.where(c("identity_status") != "ACCEPTED"),
        "rejected": judged.where(
            (c("identity_status") == "ACCEPTED") & (c("quality_status") != "ACCEPTED")
        ),
    }


# Parsers by source: evidence documents in, listing rows out. Unknown sources are an error.
PARSERS = {
    MARKET_CHANNEL: market_listings, malls.CITY_CHANNEL: malls.city_listings,
    **{channel: malls.mall_parser(channel) for channel in malls.MALLS},
}


def register_parser(channel: str, parser) -> None:
    if channel in PARSERS:
        raise ValueError(f"source parser already registered: {channel}")
    PARSERS[channel] = parser


def parse(channel: str, docs: DataFrame) -> DataFrame:
    if channel not in PARSERS:
        raise ValueError(f"unknown source: {channel}")
    return PARSERS[channel](docs)

