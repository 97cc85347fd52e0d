"""Declared schemas of the stored tables; nothing is inferred."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

_AUDIT = "created_at timestamp_ntz"
_QUANTITY = (
    "quantity_value decimal(20,6), quantity_min decimal(20,6), quantity_max decimal(20,6)"
)
_DDL = {
    "brand": "brand_id string, code string, name_zh string, name_en string, status string",
    "category": """category_id string, parent_id string, code string, name_zh string,
        name_en string, level int, path string, is_leaf boolean, default_measure_type string,
        attribute_profile_code string, attribute_profile_version string, enabled boolean""",
    "item": """item_id string, category_id string, brand_id string, canonical_key string,
        item_type string, name string, series_name string, model_number string,
        base_attributes map<string,string>, record_origin string, status string""",
    "variant": f"""variant_id string, item_id string, supersedes_variant_id string,
        variant_key string, name string, gtin string, manufacturer_part_number string,
        condition_code string, measure_type string, {_QUANTITY}, base_unit string,
        package_count int, attributes map<string,string>, identity_fingerprint string,
        status string""",
    "channel": """channel_id string, code string, name string, source_type string,
        business_mode string, access_mode string, base_url string, allowed_domains array<string>,
        region_mode string, currency string, connector_code string, enabled boolean""",
    "merchant": """merchant_id string, channel_id string, merchant_key_hash string,
        external_merchant_id string, name string, seller_type string, verification_status string,
        status string, first_seen_at timestamp_ntz, last_seen_at timestamp_ntz""",
    "listing": """listing_id string, channel_id string, merchant_id string, listing_key string,
        listing_key_hash string, external_product_id string, external_sku_id string,
        price_nature string, canonical_url string, url_hash string, current_revision_id string,
        lifecycle_status string, consecutive_misses int, first_seen_at timestamp_ntz,
        last_seen_at timestamp_ntz""",
    "run": """run_id string, channel_id string, region_scope string, region_code string,
        category_scope array<string>, run_type string, trigger_type string, status string,
        adapter_version string, policy_version string, started_at timestamp_ntz,
        finished_at timestamp_ntz, discovered_count int, fetched_count int, accepted_count int,
        review_count int, rejected_count int, failed_count int,
        error_summary map<string,int>""",
    "record": """record_id string, run_id string, listing_id string,
        replayed_from_record_id string, entity_type string, entity_key string,
        request_url string, final_url string, fetch_method string, http_status int,
        fetch_status string, parse_status string, validation_status string, error_code string,
        error_message string, raw_hash string, raw_path string,
        artifact_manifest array<struct<role:string,url:string,final_url:string,
            fetched_at:string,source_date:string,source_hash:string,relative_path:string>>,
        content_type string, raw_size_bytes bigint, duration_ms int, fetched_at timestamp_ntz""",
    "revision": f"""revision_id string, listing_id string, first_record_id string,
        revision_no int, source_title string, source_category_path string,
        source_attributes map<string,string>, normalized_attributes map<string,string>,
        condition_code string, measure_type string, {_QUANTITY}, quantity_unit string,
        base_quantity_value decimal(20,6), base_quantity_min decimal(20,6),
        base_quantity_max decimal(20,6), base_unit string, package_count int,
        identity_fingerprint string, normalizer_version string, quality_status string,
        rejection_code string, first_observed_at timestamp_ntz, last_observed_at timestamp_ntz""",
    "match": """revision_id string, variant_id string, match_status string, match_method string,
        confidence decimal(5,4), matched_fields map<string,string>,
        mismatch_fields map<string,string>, matcher_version string,
        effective_from timestamp_ntz, effective_to timestamp_ntz, ingest_seq bigint""",
    "observation": """observation_key string, base_key string, supersedes_key string,
        listing_id string, revision_id string, record_id string, region_scope string,
        region_code string, currency string, original_price decimal(18,2),
        original_price_type string, current_price decimal(18,2), price_nature string,
        price_type string, pricing_basis string, promotion_label string, availability string,
        unit_price decimal(20,6), unit_price_unit string, fee_status string,
        quality_status string, rejection_code string, displayed_price_text string,
        source_hash string, observed_at timestamp_ntz, ingest_seq bigint, payload_hash string""",
    "current": """listing_id string, revision_id string, region_scope string,
        region_code string, observation_key string, observed_at timestamp_ntz,
        ingest_seq bigint""",
    "candidate": """channel string, merchant_key string, listing_key string, url string,
        category_code string, price_nature string, product_id string, sku_id string,
        source_attributes map<string,string>, region_scope string, region_code string,
        current_price decimal(18,2), original_price decimal(18,2), unit_price decimal(20,6),
        original_price_type string, price_type string, pricing_basis string,
        availability string, fee_status string, unit_price_unit string, promotion_label string,
        displayed_price_text string, evidence_hash string, rejection_code string,
        source_observed_at timestamp_ntz, fetched_at timestamp_ntz, record_id string,
        ingest_seq bigint""",
}

NAMES = tuple(_DDL)


@cache
def schema(name: str) -> StructType:
    """Schema of a stored table; needs a running session to read the declaration."""
    return StructType.fromDDL(_DDL[name])
