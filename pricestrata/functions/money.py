"""Displayed prices: which amount a text states, and whether it states one at all."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.text import WS, strip

MONEY = "decimal(18,2)"
_NUMBER = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{1,2})?"
_AMOUNT = rf"(?i)(?:RMB|CNY|[¥￥])(?:{WS})*{_NUMBER}|{_NUMBER}(?:{WS})*元"
_CONDITIONAL = "|".join(re.escape(t) for t in vocab.CONDITIONAL_TERMS)
_STARTING = rf"[0-9](?:{WS}*元)?{WS}*起"


def _sentence(text: Column, label: Column) -> Column:
    return strip(F.concat(F.coalesce(label, F.lit("")), F.lit(" "), text))


def is_conditional(text: Column, label: Column) -> Column:
    return _sentence(text, label).rlike(f"{_CONDITIONAL}|{_STARTING}")


def with_amount(df: DataFrame, out: str, text: Column, label: Column | None = None) -> DataFrame:
    """Adds struct(amount, status): exactly one distinct positive amount, or a reason.

    Built in steps, so that each pattern runs once per row however often its result is used.
    """
    label = F.lit("") if label is None else label
    c = F.col
    none = F.lit(None).cast("string")
    return (
        df.withColumns({"__text": text, "__said": _sentence(text, label), "__plain": strip(text)})
        .withColumns(
            {
                "__hard": c("__said").rlike(f"{_CONDITIONAL}|{_STARTING}"),
                "__marked": F.regexp_extract_all("__said", F.lit(f"({_AMOUNT})"), F.lit(1)),
            }
        )
        .withColumn(
            "__list",
            F.when(F.size("__marked") > 0, c("__marked")).when(
                c("__plain").rlike(rf"^{_NUMBER}\z"), F.array("__plain")
            ),
        )
        .withColumn(
            "__list",
            F.array_distinct(
                F.transform(
                    "__list", lambda m: F.regexp_replace(m, "[^0-9.]", "").try_cast(MONEY)
                )
            ),
        )
        .withColumn("__one", F.get("__list", F.lit(0)))
        .withColumn(
            "__state",
            F.when(c("__text").isNull(), none)
            .when(c("__hard"), "CONDITIONAL")
            .when(c("__list").isNull(), "NO_AMOUNT")
            .when(F.size("__list") > 1, "AMBIGUOUS")
            .when(c("__one") > 0, "OK")
            .otherwise("NO_AMOUNT"),
        )
        .withColumn(
            out,
            F.struct(
                F.when(c("__state") == "OK", c("__one")).alias("amount"),
                c("__state").alias("status"),
            ),
        )
        .drop("__text", "__said", "__plain", "__hard", "__marked", "__list", "__one", "__state")
    )


def original_type(text: Column, label: Column) -> Column:
    both = F.concat(F.coalesce(label, F.lit("")), F.lit(" "), text)
    return (
        F.when(text.isNull(), "NONE")
        .when(F.contains(both, F.lit("划线")), "CROSSED_OUT")
        .when(both.rlike("建议|零售价"), "MSRP")
        .otherwise("EXPLICIT_ORIGINAL")
    )


def with_pair(
    df: DataFrame,
    out: str,
    original: Column,
    original_label: Column,
    current: Column,
    current_label: Column,
) -> DataFrame:
    """Adds struct(original_price, original_price_type, current_price, error).

    An original equal to the current price carries no information and is dropped.
    """
    o, n = F.col("__o"), F.col("__n")
    keep = original.isNotNull() & ~o["amount"].eqNullSafe(n["amount"])
    error = F.when(o["status"] != "OK", o["status"]).when(n["status"] != "OK", n["status"])
    both = with_amount(
        with_amount(df, "__o", original, original_label), "__n", current, current_label
    )
    return both.withColumn(
        out,
        F.struct(
            F.when(keep, o["amount"]).alias("original_price"),
            F.when(keep, original_type(original, original_label))
            .otherwise("NONE")
            .alias("original_price_type"),
            n["amount"].alias("current_price"),
            error.alias("error"),
        ),
    ).drop("__o", "__n")


def with_agreement(df: DataFrame, out: str, raw: Column, display: Column) -> DataFrame:
    """Adds struct(text, error): the raw and the displayed form of one amount must agree."""
    r, d = F.col("__r"), F.col("__d")
    both = raw.isNotNull() & display.isNotNull()
    error = (
        F.when(both & (r["status"] != "OK"), r["status"])
        .when(both & (d["status"] != "OK"), d["status"])
        .when(both & (r["amount"] != d["amount"]), "AMOUNT_MISMATCH")
    )
    return (
        with_amount(with_amount(df, "__r", raw), "__d", display)
        .withColumn(
            out,
            F.struct(
                F.when(error.isNull(), F.coalesce(raw, display)).alias("text"),
                error.alias("error"),
            ),
        )
        .drop("__r", "__d")
    )


def strict_price(col: Column) -> Column:
    """Positive price text without leading zeros and with at most two decimals, else NULL."""
    value = F.when(col.rlike(r"^(?:0|[1-9][0-9]*)(?:\.[0-9]{1,2})?\z"), col).try_cast(MONEY)
    return F.when(value > 0, value)


def published_price(value: Column, number_format: Column) -> Column:
    """Price cell of a sheet: its number format must show exactly two decimals."""
    shown = F.regexp_extract(number_format, r"0\.([0#]+)", 1)
    amount = F.round(value.try_cast("decimal(38,12)"), 2).try_cast(MONEY)
    return F.when((F.length(shown) == 2) & (value.try_cast("decimal(38,12)") > 0), amount)


def unit_price(price: Column, base_quantity: Column) -> Column:
    """price / base quantity, HALF_UP at six decimals, in exact integer arithmetic."""
    nano = (base_quantity.cast("decimal(20,9)") * F.lit(10**9).cast("decimal(10,0)")).cast(
        "decimal(29,0)"
    )
    doubled = (price * F.lit(2 * 10**15).cast("decimal(16,0)")).cast("decimal(37,0)")
    micros = F.call_function("div", doubled + nano, nano * F.lit(2).cast("decimal(1,0)"))
    return (micros.cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast(
        "decimal(20,6)"
    )
