"""Gate, keys, append and the current-price projection over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.functions.identity import to_utc_millis
from pricestrata.operators import facts as ops
from pricestrata.operators.policy import eligible, evaluate
from pricestrata.queries import query
from pricestrata.queries.sqltext import ADAPTER, facts, gated


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "candidates")
    return bind.settled(rows).withColumn("observed_at", to_utc_millis(F.col("ts")))


def price_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.with_keys(evaluate(candidates(spark, sf_dir)), ADAPTER)


@query(
    "price_gate",
    "RUL-01 FN-37",
    gated()
    + """SELECT event_id, region_scope, region_code, unit_price, unit_price_unit, quality_status,
                rejection_code FROM gated""",
)
def price_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(candidates(spark, sf_dir)).select(
        "event_id", "region_scope", "region_code", "unit_price", "unit_price_unit",
        "quality_status", "rejection_code",
    )


@query(
    "accepted_fact_eligibility",
    "RUL-02",
    gated()
    + """SELECT event_id, quality_status,
           CASE WHEN price_type = 'AVAILABILITY_ONLY' AND price_nature = 'RETAIL_OFFER'
                  THEN region_scope != 'UNKNOWN' AND current_price IS NULL
                    AND original_price IS NULL AND unit_price IS NULL AND unit_price_unit IS NULL
                    AND availability IN ('OFF_SHELF', 'OUT_OF_STOCK', 'COMING_SOON')
                    AND pricing_basis = 'UNKNOWN' AND fee_status = 'NOT_APPLICABLE'
                    AND promotion_label IS NULL
                WHEN current_price IS NULL OR region_scope = 'UNKNOWN'
                     OR price_nature = 'UNKNOWN' THEN false
                WHEN pricing_basis = 'UNIT_QUOTED' AND unit_price IS NULL THEN false
                WHEN pricing_basis NOT IN ('UNIT_QUOTED', 'PACKAGE_TOTAL') THEN false
                WHEN price_nature LIKE '%OFFER' THEN price_type = 'DIRECT_UNCONDITIONAL'
                     AND fee_status IN ('ITEM_ONLY', 'SEPARATE_FEES_EXCLUDED')
                ELSE price_type = 'PUBLISHED_VALUE' AND fee_status = 'NOT_APPLICABLE' END
             AS eligible
         FROM gated""",
)
def accepted_fact_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate(candidates(spark, sf_dir)).select(
        "event_id", "quality_status", eligible().alias("eligible")
    )


@query(
    "observation_keys",
    "FN-32 FN-35",
    facts() + "SELECT event_id, observed_at, payload_hash, observation_key FROM facts",
)
def observation_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_facts(spark, sf_dir).select(
        "event_id", "observed_at", "payload_hash", "observation_key"
    )


@query(
    "current_price_projection",
    "WIN-01 SRC-01",
    facts(
        extra="""live AS (
  SELECT a.* FROM accepted a JOIN chosen c USING (listing_id, revision_id) WHERE NOT c.conflict)"""
    )
    + """SELECT listing_id, region_scope, region_code, revision_id, observation_key,
           CAST(current_price AS VARCHAR) AS current_price, availability, observed_at
         FROM live
         QUALIFY row_number() OVER (PARTITION BY listing_id, region_scope, region_code
                                    ORDER BY observed_at DESC, ingest_seq DESC) = 1""",
)
def current_price_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = ops.rebuild_current(price_facts(spark, sf_dir)).drop("ingest_seq")
    return current.withColumn("current_price", F.col("current_price").cast("string"))
