"""Canonical JSON, fingerprints and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricestrata.functions.text import decimal_token, strip

# Control characters whose JSON escape has letters; canonical form is lower case.
_UPPER_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def canonical_json(value: Column, keep_nulls: bool = True) -> Column:
    """Compact JSON with lower-case control escapes; struct fields must be in key order.

    The value appears once in the expression: a guard that tests it first would triple every
    key that is nested in another key. Escaped backslashes are set aside as a raw control
    character, which JSON text cannot hold, so that what is left of a control escape is one.
    """
    text = F.to_json(value, {"ignoreNullFields": "false" if keep_nulls else "true"})
    backslashes, aside = F.lit("\\\\"), F.lit("\x01")
    text = F.replace(text, backslashes, aside)
    for code in _UPPER_ESCAPES:
        text = F.replace(text, F.lit(f"\\u00{code}"), F.lit(f"\\u00{code.lower()}"))
    return F.replace(text, aside, backslashes)


def sha256(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def json_hash(*parts: Column) -> Column:
    """sha256 of a JSON array of strings."""
    return sha256(canonical_json(F.array(*parts)))


def is_sha256(col: Column) -> Column:
    return F.lower(col).rlike(r"^[0-9a-f]{64}\z")


def sorted_map(col: Column) -> Column:
    return F.map_from_entries(F.array_sort(F.map_entries(col)))


def spec_fingerprint(entries: Column) -> Column:
    """sha256 of canonical JSON of normalised entries; the last of equal keys wins."""
    return sha256(canonical_json(F.map_from_entries(F.array_sort(last_per_key(entries)))))


def last_per_key(entries: Column) -> Column:
    """Keep the last entry of every key, as a dictionary assignment would."""
    return F.filter(
        entries,
        lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]
        ),
    )


def listing_fingerprint(
    attributes: Column,
    condition: Column,
    measure: Column,
    quantity: dict[str, Column],
    base: dict[str, Column],
    package_count: Column,
) -> Column:
    """Identity of what is sold; a base quantity replaces the source quantity."""
    has_base = base["value"].isNotNull() | base["min"].isNotNull()

    def source(name: str) -> Column:
        return F.when(~has_base, decimal_token(quantity[name]))

    payload = F.struct(
        decimal_token(base["max"]).alias("base_quantity_max"),
        decimal_token(base["min"]).alias("base_quantity_min"),
        decimal_token(base["value"]).alias("base_quantity_value"),
        base["unit"].alias("base_unit"),
        condition.alias("condition_code"),
        measure.alias("measure_type"),
        sorted_map(attributes).alias("normalized_attributes"),
        package_count.alias("package_count"),
        source("max").alias("quantity_max"),
        source("min").alias("quantity_min"),
        F.when(~has_base, quantity["unit"]).alias("quantity_unit"),
        source("value").alias("quantity_value"),
    )
    return sha256(canonical_json(payload))


def _joined(*parts: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


PAYLOAD_FIELDS = (
    "currency", "original_price", "original_price_type", "current_price", "price_nature",
    "price_type", "pricing_basis", "promotion_label", "availability", "unit_price",
    "unit_price_unit", "fee_status", "quality_status", "rejection_code", "displayed_price_text",
)


def payload_hash(supersedes: Column | None = None) -> Column:
    """Hash of every monetary and status field plus the fact it corrects, if any."""
    tail = F.lit(None).cast("string") if supersedes is None else supersedes
    return sha256(_joined(*[F.col(n) for n in PAYLOAD_FIELDS], tail))


def observation_key(
    adapter_version: Column, policy_version: Column, supersedes: Column | None = None
) -> Column:
    """Key of one price fact: place, instant, evidence, payload and rule versions."""
    instant = F.date_format(F.col("observed_at"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return sha256(
        _joined(
            F.col("listing_id"),
            F.col("revision_id"),
            F.col("region_scope"),
            F.col("region_code"),
            instant,
            F.col("source_hash"),
            payload_hash(supersedes),
            strip(adapter_version),
            strip(policy_version),
        )
    )


def multiset_signature(text: Column) -> list[Column]:
    """Mergeable, order-free aggregate of a multiset of texts: row count and two 60-bit lanes.

    Two groups hold the same texts the same number of times exactly when the three values
    agree (up to hash collision); unlike a sorted list it combines before the shuffle.
    """
    digest = sha256(text)

    def lane(start: int) -> Column:
        value = F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")
        return F.sum(value)

    return [
        F.count(text).alias("signature_rows"),
        lane(1).cast("string").alias("signature_a"),
        lane(16).cast("string").alias("signature_b"),
    ]


def to_utc_millis(col: Column) -> Column:
    return F.date_trunc("MILLISECOND", col).cast("timestamp_ntz")


def source_day_utc(day: Column) -> Column:
    """Midnight of a source day in Shanghai as naive UTC."""
    return F.to_utc_timestamp(day.cast("timestamp_ntz"), "Asia/Shanghai").cast("timestamp_ntz")


def entity_key(product_id: Column, dataset_key: Column) -> Column:
    return F.when(product_id.isNotNull(), product_id).otherwise(
        F.concat(F.lit("PUBLIC_PRICE:"), sha256(dataset_key))
    )
