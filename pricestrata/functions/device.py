"""Device wording and specifications, driven by the per-brand tables in vocab."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.identity import (
    canonical_json,
    sha256,
    spec_fingerprint,
)
from pricestrata.functions.money import with_pair
from pricestrata.functions.text import (
    WS,
    capacity,
    capacity_token,
    nfkc_array,
    normalize_text,
    plain,
    squeeze,
    strip,
)

SPEC_TYPE = "struct<" + ",".join(f"{n}:string" for n in vocab.SPEC_FIELDS) + (
    ",attributes:map<string,string>>"
)


def ordered_case(rules: list[tuple[Column, str]], default: Column) -> Column:
    """First true rule wins; rules are data, the CASE is compiled once."""
    if not rules:
        return default
    first, *rest = rules
    start = F.when(first[0], first[1])
    return reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rest, start).otherwise(default)


def _any_of(terms: tuple[str, ...]) -> str:
    return "|".join(re.escape(t) for t in terms)


def availability_from_text(brand: str, text: Column) -> Column:
    rules = [
        (text.rlike(_any_of(terms)), state)
        for state, terms in vocab.AVAILABILITY_TERMS[brand]
    ]
    return ordered_case(rules, F.lit(vocab.AVAILABILITY_DEFAULT.get(brand, "UNKNOWN")))


def availability_by_brand(brand: Column, text: Column) -> Column:
    rules = [(brand == b, availability_from_text(b, text)) for b in vocab.AVAILABILITY_TERMS]
    return ordered_case(rules, F.lit("UNKNOWN"))


def availability_from_flags(
    down: Column, zero_stock: Column, marketable: Column, has_store: Column
) -> Column:
    """Detail-map source: withdrawn, then no stock, then both positive flags."""
    yes = F.coalesce
    return (
        F.when(yes(down, F.lit(False)) | yes(marketable == 0, F.lit(False)), "OFF_SHELF")
        .when(yes(zero_stock, F.lit(False)) | yes(has_store == 0, F.lit(False)), "OUT_OF_STOCK")
        .when((has_store == 1) & (marketable == 1), "ON_SALE")
        .otherwise("UNKNOWN")
    )


def availability_from_inventory(coming_soon: Column, inventory: Column) -> Column:
    """Embedded-JSON source: zero inventory says nothing before a region is chosen."""
    return (
        F.when(coming_soon == 1, "COMING_SOON").when(inventory > 0, "ON_SALE").otherwise("UNKNOWN")
    )


def _category(brand: str, text: Column, upper: Column) -> Column:
    """Approved category of a normalised name, NULL when excluded or unknown."""
    rules = vocab.NAME_RULES[brand]
    cased = vocab.CASED_EXCLUSIONS.get(brand, ())
    words = tuple(w for w in rules["exclude"] if w not in cased)
    excluded = upper.rlike(_any_of(words))
    if cased:
        excluded = excluded | text.rlike(_any_of(cased))
    if "exclude_start" in rules:
        excluded = excluded | upper.rlike(f"^(?:{_any_of(rules['exclude_start'])})")
    picked = ordered_case(
        [
            (upper.rlike(f"^(?:{pattern})".replace(r"\s", WS)), code)
            for code, pattern in rules["categories"]
        ],
        F.lit(None).cast("string"),
    )
    return F.when(~excluded, picked)


def with_category(df: DataFrame, out: str, brand: Column, name: Column) -> DataFrame:
    """Adds the category a brand's name rules give; the name is normalised once."""
    text, upper = F.col("__name"), F.col("__upper")
    rules = [(brand == b, _category(b, text, upper)) for b in vocab.NAME_RULES]
    return (
        plain(plain(df.withColumn("__name", normalize_text(name))).withColumn("__upper", F.upper("__name")))
        .withColumn(out, ordered_case(rules, F.lit(None).cast("string")))
        .drop("__name", "__upper")
    )


_MEMORY = rf"(?i)([0-9]+{WS}*GB){WS}*(?:\+|/){WS}*([0-9]+{WS}*(?:GB|TB))"
_MEMORY_PLUS = _MEMORY.replace(r"(?:\+|/)", r"\+")


def split_version(version: Column, brand: str = "XIAOMI") -> Column:
    """struct(memory, capacity, edition) of a version text such as ``Pro 12GB+256GB 典藏版``.

    Brands OPPO and VIVO accept only ``+`` between the two sizes; the edition remainder is
    kept for the brand that has no separate edition field.
    """
    pattern = _MEMORY_PLUS if brand in ("OPPO", "VIVO") else _MEMORY
    hit = version.rlike(pattern)
    edges = rf"^[ /+]+|[ /+]+\z"
    before = F.regexp_replace(F.regexp_extract(version, rf"^(.*?){pattern}", 1), edges, "")
    after = F.regexp_replace(F.regexp_extract(version, rf"{pattern}(.*)\z", 3), edges, "")
    rest = squeeze(F.concat_ws(" ", before, after))
    return F.struct(
        F.when(hit, capacity(F.regexp_extract(version, pattern, 1))).alias("memory"),
        F.when(hit, capacity(F.regexp_extract(version, pattern, 2))).alias("capacity"),
        F.when(hit, F.when(rest != "", rest))
        .when(version != "", version)
        .alias("edition"),
    )


def with_specification(
    df: DataFrame, out: str, fields: dict[str, Column], normalized: Column
) -> DataFrame:
    """Adds struct(spec, json, error): only proven configuration identifies a device.

    ``normalized`` comes from ``with_normalized_entries``. ``json`` is the canonical text of the
    proven fields, keys in order and empty fields absent; both are NULL on an error.
    """
    c = F.col
    cleaned = {}
    for i, name in enumerate(vocab.SPEC_FIELDS):
        text = squeeze(F.get("__nfkc", F.lit(i)))
        cleaned[f"__f_{name}"] = (
            capacity_token(text) if name in ("capacity", "memory") else text
        )
    none = F.lit(None).cast("string")
    # All fields go through NFKC together: one Arrow exchange instead of one per field.
    texts = (
        df.withColumn("__raw", F.array(*[fields.get(n, none) for n in vocab.SPEC_FIELDS]))
        .withColumn("__nfkc", nfkc_array(c("__raw")))
        .withColumns(cleaned)
        .drop("__raw", "__nfkc")
    )
    trimmed = texts.withColumns({n: F.when(c(n) != "", c(n)) for n in cleaned}).withColumn(
        "__e", F.coalesce(normalized, F.array().cast("array<struct<key:string,value:string>>"))
    )
    keyed = trimmed.withColumn("__keys", F.transform("__e", lambda e: e["key"]))
    blank = F.exists(
        "__e", lambda e: (e["key"] == "") | (F.coalesce(e["value"], F.lit("")) == "")
    )
    proven = F.size("__e") > 0
    for name in cleaned:
        proven = proven | c(name).isNotNull()
    judged = keyed.withColumn(
        "__error",
        F.when(blank, "BLANK_DIMENSION")
        .when(F.size(F.array_distinct("__keys")) < F.size("__keys"), "REPEATED_DIMENSION")
        .when(
            F.arrays_overlap("__keys", F.array(*map(F.lit, vocab.MUTABLE_KEYS))),
            "MUTABLE_DIMENSION",
        )
        .when(~proven, "NOTHING_PROVEN"),
    ).withColumn(
        "__attributes",
        F.when(
            c("__error").isNull() & (F.size("__e") > 0), F.map_from_entries(F.array_sort("__e"))
        ),
    )
    ok = c("__error").isNull()
    values = {n: c(f"__f_{n}").alias(n) for n in vocab.SPEC_FIELDS}
    in_order = F.struct(
        c("__attributes").alias("attributes"), *[values[n] for n in sorted(vocab.SPEC_FIELDS)]
    )
    as_stored = F.struct(*values.values(), c("__attributes").alias("attributes"))
    return (
        judged.withColumn("__json", F.when(ok, canonical_json(in_order, keep_nulls=False)))
        .withColumn(
            out,
            F.struct(
                F.when(ok, as_stored).alias("spec"),
                c("__json").alias("json"),
                c("__error").alias("error"),
            ),
        )
        .drop(*cleaned, "__e", "__keys", "__error", "__attributes", "__json")
    )


def item_key(brand: Column, channel: Column, product: Column) -> Column:
    """Key of a standard device item, NULL when any part is blank."""
    parts = [F.upper(strip(brand)), F.upper(strip(channel)), strip(product)]
    full = (parts[0] != "") & (parts[1] != "") & (parts[2] != "")
    return F.when(full, sha256(canonical_json(F.array(*parts))))


def listing_key(product: Column, sku: Column, spec_json: Column) -> Column:
    """JSON [product, "sku"|"spec", id]; the specification stands in when there is no SKU."""
    parts = F.when(sku.isNotNull(), F.array(strip(product), F.lit("sku"), strip(sku))).when(
        spec_json.isNotNull(), F.array(strip(product), F.lit("spec"), sha256(spec_json))
    )
    return canonical_json(parts)


def map_dimensions(brand: str, dimensions: Column) -> tuple[dict[str, Column], Column]:
    """Split source dimensions into specification fields and the attribute map that remains."""
    table = vocab.DIMENSION_FIELDS[brand]
    fields = {}
    for name, keys in table.items():
        values = [F.try_element_at(dimensions, F.lit(k)) for k in keys]
        fields[name] = F.coalesce(*[F.when(v != "", v) for v in values])
    used = [k for keys in table.values() for k in keys if k not in vocab.DIMENSIONS_KEPT.get(brand, ())]
    rest = F.map_filter(dimensions, lambda k, v: ~k.isin(used) & (F.coalesce(v, F.lit("")) != ""))
    return fields, rest


def display_title(*parts: Column) -> Column:
    """Distinct non-empty parts in first-seen order."""
    kept = F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != ""))
    return F.array_join(F.array_distinct(kept), " ")


def with_price_candidate(
    df: DataFrame,
    out: str,
    current_text: Column,
    original_text: Column,
    original_label: Column,
    current_label: Column,
    availability: Column,
) -> DataFrame:
    """Adds the price terms of one SKU: a direct price, a stated non-selling state, or an error."""
    pair = F.col("__pair")
    priced = current_text.isNotNull()
    silent = ~priced & availability.isin(*vocab.NON_SELLING)
    null_text = F.lit(None).cast("string")
    terms = F.struct(
        pair["current_price"].alias("current_price"),
        F.when(priced, pair["original_price"]).alias("original_price"),
        F.when(priced, pair["original_price_type"]).otherwise("NONE").alias("original_price_type"),
        F.when(priced, "DIRECT_UNCONDITIONAL").when(silent, "AVAILABILITY_ONLY").alias("price_type"),
        F.when(priced, "PACKAGE_TOTAL").when(silent, "UNKNOWN").alias("pricing_basis"),
        F.when(priced, "ITEM_ONLY").when(silent, "NOT_APPLICABLE").alias("fee_status"),
        availability.alias("availability"),
        F.when(priced, current_text).alias("displayed_price_text"),
        F.when(priced, pair["error"])
        .when(~silent, "PRICE_UNSTATED")
        .otherwise(null_text)
        .alias("error"),
    )
    return (
        with_pair(df, "__pair", original_text, original_label, current_text, current_label)
        .withColumn(out, terms)
        .drop("__pair")
    )


__all__ = [
    "SPEC_TYPE", "availability_by_brand", "availability_from_flags", "availability_from_inventory",
    "availability_from_text", "display_title",
    "item_key", "listing_key", "map_dimensions", "ordered_case",
    "spec_fingerprint", "split_version",
    "with_category", "with_price_candidate", "with_specification",
]
