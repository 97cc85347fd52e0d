"""Identity rules per category profile, declared as data and compiled to Column code."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.device import (
    listing_key,
    ordered_case,
    with_specification,
)
from pricestrata.functions.identity import listing_fingerprint
from pricestrata.functions.quantity import BASE, QTY, with_quantity
from pricestrata.functions.text import (
    blank_to_null,
    commodity_code,
    compact,
    origin_token,
    positive_decimal_text,
    source_text,
    upper_token,
    with_normalized_entries,
)
from pricestrata.sources.seeds import categories

Normalizer = Callable[[Column], Column]


def alias_code(name: str, value: Column) -> Column:
    """Code of a known word of one field, NULL for an unsupported word."""
    token = F.upper(compact(value))
    groups: dict[str, list[str]] = {}
    for word, code in vocab.ALIASES[name].items():
        groups.setdefault(code, []).append(word)
    return ordered_case(
        [(token.isin(words), F.lit(code)) for code, words in groups.items()],
        F.lit(None).cast("string"),
    )


def quoted_unit(value: Column) -> Column:
    token = F.lower(compact(value))
    groups: dict[str, list[str]] = {}
    for word, code in vocab.QUOTED_UNITS.items():
        groups.setdefault(code, []).append(word)
    return ordered_case(
        [(token.isin(words), F.lit(code)) for code, words in groups.items()],
        F.lit(None).cast("string"),
    )


def _alias(name: str) -> Normalizer:
    return lambda value: alias_code(name, value)


@dataclass(frozen=True)
class IdentityRule:
    """Required and optional source fields, how each is read, and the measure of net content."""

    profile: str
    version: str
    measure: str
    required: dict[str, Normalizer]
    optional: dict[str, Normalizer] = field(default_factory=dict)
    fixed: dict[str, str] = field(default_factory=dict)


_SHARED = {
    "origin": origin_token,
    "grade": _alias("grade"),
    "freshness_state": _alias("freshness_state"),
    "packaging": _alias("packaging"),
}

RULES: dict[tuple[str, str], IdentityRule] = {}


def register_rule(rule: IdentityRule) -> None:
    key = (rule.profile, rule.version)
    if key in RULES:
        raise ValueError(f"rule already registered: {rule.profile}@{rule.version}")
    RULES[key] = rule


def get_rule(profile: str, version: str) -> IdentityRule:
    if (profile, version) not in RULES:
        raise ValueError(f"unknown category rule: {profile}@{version}")
    return RULES[profile, version]


register_rule(
    IdentityRule(
        "fresh-apple", "1", "WEIGHT", {"variety": _alias("variety"), **_SHARED},
        {"fruit_diameter_mm": positive_decimal_text},
    )
)
register_rule(
    IdentityRule(
        "packaged-egg", "1", "COUNT", {"egg_type": _alias("egg_type"), **_SHARED},
        {"shell_color": upper_token},
    )
)
register_rule(
    IdentityRule(
        "fresh-pork", "1", "WEIGHT", {"cut": _alias("cut"), **_SHARED},
        {"bone_state": _alias("bone_state"), "skin_state": _alias("skin_state")},
        {"animal_type": "PORK"},
    )
)
register_rule(
    IdentityRule(
        "government-fresh", "1", "WEIGHT",
        {
            "commodity_code": commodity_code,
            "commodity_name": source_text,
            "commodity_group": _alias("commodity_group"),
            "source_specification": source_text,
            "quoted_unit": quoted_unit,
        },
    )
)
QUOTED_PROFILE = "government-fresh"
DEVICE_PROFILE = "electronic-device"


def _attributes(rule: IdentityRule) -> tuple[Column, Column, Column]:
    """(attributes, unsupported, missing) of one rule over the read fields.

    Attributes read before the first unsupported value stay, later ones are dropped.
    """
    entries = [
        F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in rule.fixed.items()
    ]
    failed = F.lit(False)
    missing = F.lit(False)
    for name in (*rule.required, *rule.optional):
        failed = failed | F.col(f"__x_{name}")
        if name in rule.required:
            missing = missing | F.col(f"__r_{name}").isNull()
        entries.append(
            F.struct(F.lit(name).alias("key"), F.when(~failed, F.col(f"__v_{name}")).alias("value"))
        )
    known = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.map_from_entries(F.array_sort(known)), failed, missing


def _with_readings(df: DataFrame, profile: Column, rules: list[IdentityRule]) -> DataFrame:
    """Read every field once, then judge it by the rule of the row's profile."""
    readers = {n: f for r in rules for n, f in {**r.required, **r.optional}.items()}
    source = F.col("source_attributes")
    raw = {f"__r_{n}": blank_to_null(F.try_element_at(source, F.lit(n))) for n in readers}
    raw["__net"] = blank_to_null(F.try_element_at(source, F.lit("net_content")))
    values = {
        f"__v_{n}": F.when(F.col(f"__r_{n}").isNotNull(), f(F.col(f"__r_{n}")))
        for n, f in readers.items()
    }
    flags = {
        f"__x_{n}": F.col(f"__r_{n}").isNotNull() & F.col(f"__v_{n}").isNull() for n in readers
    }
    parts = {r.profile: _attributes(r) for r in rules}

    def chosen(i: int) -> Column:
        first, *rest = parts.items()
        start = F.when(profile == first[0], first[1][i])
        return reduce(lambda acc, kv: acc.when(profile == kv[0], kv[1][i]), rest, start)

    return (
        df.withColumns(raw)
        .withColumns(values)
        .withColumns(flags)
        .withColumns(
            {"__attributes": chosen(0), "__unsupported": chosen(1), "__missing": chosen(2)}
        )
    )


def fresh_identity(df: DataFrame, profile: Column) -> DataFrame:
    """Judge every fresh-food row by the rule of its profile, in one pass.

    Order: unsupported value, missing field, unresolved quantity, quoted-unit conflict. The
    quantity is kept on a row under review whenever its text can be read.
    """
    fresh = [r for r in RULES.values() if r.profile != DEVICE_PROFILE]
    measure = ordered_case(
        [(profile == r.profile, F.lit(r.measure)) for r in fresh], F.lit(None).cast("string")
    )
    c = F.col
    quoted = c("__v_quoted_unit")
    fits = F.lit(False)
    for unit, base in vocab.QUOTED_BASE.items():
        fits = fits | ((quoted == unit) & (c("q.base_quantity_value") == F.lit(base).cast(BASE)))
    code = (
        F.when(c("__missing").isNull(), "RULE_UNKNOWN")
        .when(c("__unsupported"), "IDENTITY_VALUE_UNSUPPORTED")
        .when(c("__missing"), "IDENTITY_FIELDS_MISSING")
        .when(c("__net").isNull() | c("q.error").isNotNull(), "QUANTITY_UNRESOLVED")
        .when(
            (profile == QUOTED_PROFILE)
            & ~F.coalesce(fits & (c("q.base_unit") == "KG"), F.lit(False)),
            "QUOTED_UNIT_MISMATCH",
        )
    )
    read = _with_readings(df, profile, fresh).withColumn("measure_type", measure)
    judged = with_quantity(read, "q", c("__net"), c("measure_type")).withColumn(
        "identity_code", code
    )
    return judged.select(
        *df.columns,
        c("__attributes").alias("normalized_attributes"),
        F.lit("NEW").alias("condition_code"),
        "measure_type",
        *[
            c(f"q.{n}").alias(n)
            for n in (
                "quantity_value", "quantity_min", "quantity_max", "quantity_unit",
                "base_quantity_value", "base_quantity_min", "base_quantity_max", "base_unit",
                "package_count",
            )
        ],
        F.when(c("identity_code").isNull(), "ACCEPTED")
        .otherwise("REVIEW_REQUIRED")
        .alias("identity_status"),
        "identity_code",
    )


def with_fingerprint(df: DataFrame) -> DataFrame:
    c = F.col
    return df.withColumn(
        "identity_fingerprint",
        listing_fingerprint(
            c("normalized_attributes"),
            c("condition_code"),
            c("measure_type"),
            {n: c(f"quantity_{n}") for n in ("value", "min", "max", "unit")},
            {
                "value": c("base_quantity_value"),
                "min": c("base_quantity_min"),
                "max": c("base_quantity_max"),
                "unit": c("base_unit"),
            },
            c("package_count"),
        ),
    )


def device_identity(df: DataFrame) -> DataFrame:
    """Device rows: approved category, official retail identity, proven spec, recomputed key."""
    c = F.col
    fields = {n: F.try_element_at(c("spec_fields"), F.lit(n)) for n in vocab.SPEC_FIELDS}
    source_ok = (
        c("external_product_id").isNotNull()
        & (c("external_product_id") != "")
        & (c("price_nature") == "RETAIL_OFFER")
    )
    prepared = with_normalized_entries(df, "spec_attributes", "entries")
    judged = with_specification(prepared, "s", fields, c("entries")).withColumn(
        "expected_key", listing_key(c("external_product_id"), c("external_sku_id"), c("s.json"))
    )
    code = (
        F.when(~c("category_code").isin(*vocab.DEVICE_CATEGORIES), "DEVICE_CATEGORY_UNSUPPORTED")
        .when(~F.coalesce(source_ok, F.lit(False)), "DEVICE_SOURCE_IDENTITY_INVALID")
        .when(c("s.error").isNotNull(), "DEVICE_SPECIFICATION_UNPROVEN")
        .when(c("listing_key") != c("expected_key"), "DEVICE_LISTING_KEY_MISMATCH")
    )
    return judged.withColumn("identity_code", code).select(
        *df.columns,
        "expected_key",
        c("s.json").alias("identity_json"),
        F.lit("COUNT").alias("measure_type"),
        F.lit("PIECE").alias("base_unit"),
        F.lit("1").cast(QTY).alias("base_quantity_value"),
        F.lit(1).alias("package_count"),
        "identity_code",
        F.when(c("identity_code").isNull(), "ACCEPTED")
        .otherwise("REVIEW_REQUIRED")
        .alias("identity_status"),
    )


def dispatch(df: DataFrame) -> DataFrame:
    """Attach profile and rule version of every row; only enabled leaves have a rule."""
    dim = categories(df.sparkSession).select(
        F.col("code").alias("category_code"),
        F.col("attribute_profile_code").alias("profile"),
        F.col("attribute_profile_version").alias("profile_version"),
        "is_leaf",
        "enabled",
    )
    known = [f"{p}@{v}" for p, v in RULES] + [f"{DEVICE_PROFILE}@1"]
    version = F.concat_ws("@", F.col("profile"), F.col("profile_version"))
    error = (
        F.when(F.col("profile").isNull(), "CATEGORY_UNKNOWN")
        .when(~(F.col("is_leaf") & F.col("enabled")), "CATEGORY_NOT_ENABLED_LEAF")
        .when(~version.isin(known), "RULE_UNKNOWN")
    )
    return (
        df.join(F.broadcast(dim), "category_code", "left")
        .withColumn("dispatch_error", error)
        .withColumn("normalizer_version", F.when(error.isNull(), version))
        .drop("is_leaf", "enabled", "profile_version")
    )
