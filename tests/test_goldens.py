"""Golden values of the scalar rules."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricestrata.functions import identity, money, text, urls
from pricestrata.functions.quantity import with_quantity
from pricestrata.operators.rules import IdentityRule, get_rule, register_rule

c = F.col


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(c("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("source", "measure", "base", "unit", "packs"),
    [
        ("5kg", "WEIGHT", "5", "KG", None),
        ("5000 克", "WEIGHT", "5", "KG", None),
        ("1斤", "WEIGHT", "0.5", "KG", None),
        ("2盒×15枚", "COUNT", "30", "PIECE", 30),
        ("250毫升", "VOLUME", "0.25", "L", None),
    ],
)
def test_exact_quantities(spark, source, measure, base, unit, packs):
    df = spark.createDataFrame([(source,)], "v string")
    q = with_quantity(df, "q", c("v"), F.lit(measure)).first()["q"]
    assert q["error"] is None
    assert q["base_quantity_value"] == Decimal(base)
    assert (q["base_unit"], q["package_count"]) == (unit, packs)


def test_range_quantity(spark):
    df = spark.createDataFrame([("400-500g",)], "v string")
    q = with_quantity(df, "q", c("v"), F.lit("WEIGHT")).first()["q"]
    assert (q["base_quantity_min"], q["base_quantity_max"]) == (Decimal("0.4"), Decimal("0.5"))


@pytest.mark.parametrize(
    ("source", "measure"),
    [("约5kg", "WEIGHT"), ("5磅", "WEIGHT"), ("1.5枚", "COUNT"), ("500-400g", "WEIGHT"), ("5kg", "COUNT"), ("0kg", "WEIGHT")],
)
def test_refused_quantities(spark, source, measure):
    df = spark.createDataFrame([(source,)], "v string")
    assert with_quantity(df, "q", c("v"), F.lit(measure)).first()["q"]["error"] is not None


@pytest.mark.parametrize(
    ("shown", "label", "amount", "status"),
    [
        ("RMB 8,999", "", "8999.00", "OK"),
        ("¥ 2,999.5", "现价", "2999.50", "OK"),
        ("3999 元", "", "3999.00", "OK"),
        ("4299", "", "4299.00", "OK"),
        ("¥1 ¥2", "", None, "AMBIGUOUS"),
        ("3999元起", "", None, "CONDITIONAL"),
        ("¥3999", "国补到手价", None, "CONDITIONAL"),
        ("¥0", "", None, "NO_AMOUNT"),
        ("暂无报价", "", None, "NO_AMOUNT"),
    ],
)
def test_money(spark, shown, label, amount, status):
    df = spark.createDataFrame([(shown, label)], "t string, l string")
    m = money.with_amount(df, "m", c("t"), c("l")).first()["m"]
    assert m["status"] == status
    assert m["amount"] == (Decimal(amount) if amount else None)


@pytest.mark.parametrize(
    ("price", "base", "expected"),
    [("79", "5", "15.800000"), ("32.80", "30", "1.093333"), ("28.80", "0.5", "57.600000"),
     ("6.80", "0.5", "13.600000"), ("0.01", "3", "0.003333"), ("1.00", "0.0003", "3333.333333")],
)
def test_unit_price(spark, price, base, expected):
    df = spark.createDataFrame([(Decimal(price), Decimal(base))], "p decimal(18,2), b decimal(29,9)")
    assert df.select(money.unit_price(c("p"), c("b"))).first()[0] == Decimal(expected)


def test_text(spark):
    assert one(spark, "　Ａ\x1cb ", text.normalize_text) == "A b"
    assert one(spark, "　 ", text.blank_to_null) is None
    assert one(spark, "１ ＴＢ", text.capacity) == "1TB"
    assert one(spark, "ﬁne", text.normalize_text) == "fine"
    assert one(spark, "80.0", text.positive_decimal_text) == "80"
    assert one(spark, "10", text.positive_decimal_text) == "10"


def test_canonical_json_control_characters(spark):
    got = one(spark, 'a\x1f"\\u001F', lambda v: identity.canonical_json(F.array(v)))
    assert got == '["a\\u001f\\"\\\\u001F"]'


@pytest.mark.parametrize(
    ("url", "verdict"),
    [
        ("https://www.mi.com/x", None), ("http://www.mi.com/", "SCHEME"),
        ("https://u:p@www.mi.com/", "CREDENTIALS"), ("https:///x", "NO_HOST"),
        ("https://evil.com/www.mi.com", "HOST"), ("https://www.mi.com:8443/", "PORT"),
        ("https://WWW.MI.COM.:443/", None), ("https://例子.cn/", None),
    ],
)
def test_url_rules(spark, url, verdict):
    allowed = ["www.mi.com", "xn--fsqu00a.cn"]
    assert one(spark, url, lambda v: urls.url_verdict(v, allowed)) == verdict


def test_absolute_links(spark):
    def join(href: str) -> str:
        return one(spark, href, lambda v: urls.absolute(F.lit("https://h/a/b?q=1"), v))

    assert join("c?d") == "https://h/a/c?d"
    assert join("/x") == "https://h/x"
    assert join("//o/x") == "https://o/x"
    assert join("http://o/y") == "http://o/y"


def test_rule_registry():
    with pytest.raises(ValueError):
        get_rule("fresh-apple", "99")
    with pytest.raises(ValueError):
        register_rule(IdentityRule("fresh-apple", "1", "WEIGHT", {}))
