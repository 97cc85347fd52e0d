"""Seed dimensions as literal rows. Their size is fixed by this package, so they broadcast."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from pricestrata.functions import vocab


def _sql_values(rows: list[tuple], names: list[str]) -> str:
    def lit(v: object) -> str:
        if v is None:
            return "CAST(NULL AS STRING)"
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, int):
            return str(v)
        if isinstance(v, tuple):
            return "array(" + ", ".join(lit(x) for x in v) + ")"
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM VALUES {body} AS t({', '.join(names)})"


@cache
def _text(name: str) -> str:
    if name == "brands":
        return _sql_values(list(vocab.BRANDS), ["code", "name_zh", "name_en"])
    if name == "channels":
        return _sql_values(
            list(vocab.CHANNELS),
            ["code", "name", "source_type", "business_mode", "access_mode", "region_mode",
             "allowed_domains", "brand_code"],
        )
    if name == "categories":
        rows = [(*row, "1", True) for row in vocab.CATEGORIES]
        return _sql_values(
            rows,
            ["code", "parent_code", "name_zh", "level", "path", "is_leaf",
             "attribute_profile_code", "default_measure_type", "attribute_profile_version",
             "enabled"],
        )
    if name == "commodities":
        return _sql_values(
            list(vocab.WHOLESALE_COMMODITIES),
            ["commodity_code", "commodity_id", "commodity_name", "commodity_group"],
        )
    if name == "city_commodities":
        return _sql_values(
            list(vocab.CITY_COMMODITIES),
            ["commodity_code", "commodity_group", "commodity_name", "specification", "unit"],
        )
    return _sql_values(list(vocab.REGION_CODES.items()), ["region_name", "region_code"])


def brands(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("brands"))


def channels(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("channels"))


def categories(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("categories"))


def commodities(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("commodities"))


def city_commodities(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("city_commodities"))


def regions(spark: SparkSession) -> DataFrame:
    return spark.sql(_text("regions"))
