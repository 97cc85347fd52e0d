"""Quantity text -> exact value or range in source and base units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.text import compact

QTY = "decimal(20,6)"
BASE = "decimal(29,9)"
_NUM = r"([0-9]+(?:\.[0-9]+)?)"
_UNIT = r"([A-Z]+|[一-鿿]+)"
_EXACT = rf"^{_NUM}{_UNIT}\z"
_RANGE = rf"^{_NUM}(?:-|~|～|至){_NUM}{_UNIT}\z"
_PACKS = r"^([0-9]+)(?:盒|包|袋|板)(?:\*|X|×)([0-9]+)(枚|个|只|PIECE|PCS|PC)\z"


def _lookup(token: Column, field: int) -> Column:
    """One attribute of the unit table as a CASE over its tokens."""
    groups: dict[str, list[str]] = {}
    for name, row in vocab.UNITS.items():
        groups.setdefault(row[field], []).append(name)
    start = F.when(F.lit(False), F.lit(None).cast("string"))
    return reduce(lambda acc, kv: acc.when(token.isin(kv[1]), kv[0]), groups.items(), start)


def unit_measure(token: Column) -> Column:
    return _lookup(token, 0)


def to_base(value: Column, token: Column) -> Column:
    """Value in the base unit (KG, L, PIECE); NULL for an unknown unit."""
    return (value.cast(QTY) * _lookup(token, 3).cast("decimal(4,3)")).cast(BASE)


def with_quantity(df: DataFrame, out: str, text: Column, measure: Column) -> DataFrame:
    """Adds a struct of the parsed quantity plus ``error`` (NULL when it is unambiguous).

    Built in steps, so that each pattern runs once per row.
    """
    c = F.col
    packs, span, exact = (c("__shape") == s for s in ("PACKS", "RANGE", "EXACT"))

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract("__t", pattern, i)

    total = (
        group(_PACKS, 1).try_cast("decimal(10,0)") * group(_PACKS, 2).try_cast("decimal(9,0)")
    ).cast(QTY)
    steps = (
        df.withColumns({"__t": F.upper(compact(text)), "__m": measure})
        .withColumn(
            "__shape",
            F.when(c("__t").rlike(_PACKS), "PACKS")
            .when(c("__t").rlike(_RANGE), "RANGE")
            .when(c("__t").rlike(_EXACT), "EXACT")
            .otherwise("NONE"),
        )
        .withColumns(
            {
                "__low": F.when(span, group(_RANGE, 1).try_cast(QTY)),
                "__high": F.when(span, group(_RANGE, 2).try_cast(QTY)),
                "__v": F.when(packs, total).when(exact, group(_EXACT, 1).try_cast(QTY)),
                "__u": F.when(packs, "PIECE")
                .when(span, group(_RANGE, 3))
                .when(exact, group(_EXACT, 2)),
            }
        )
        .withColumns(
            {"__kind": _lookup(c("__u"), 0), "__factor": _lookup(c("__u"), 3).cast("decimal(4,3)")}
        )
    )
    mismatch = "MEASURE_MISMATCH"
    error = (
        F.when(c("__t").isNull() | (c("__t") == ""), "BLANK")
        .when(c("__shape") == "NONE", "UNSUPPORTED")
        .when(packs & (c("__m") != "COUNT"), mismatch)
        .when(span & ~((c("__low") > 0) & (c("__high") > 0)), "NOT_POSITIVE")
        .when(span & (c("__high") < c("__low")), "RANGE_REVERSED")
        .when(~span & ~F.coalesce(c("__v") > 0, F.lit(False)), "NOT_POSITIVE")
        .when(exact & (c("__m") == "COUNT") & (c("__v") != F.floor(c("__v"))), "NOT_WHOLE")
        .when(c("__kind").isNull(), "UNIT_UNKNOWN")
        .when(c("__kind") != c("__m"), mismatch)
    )
    ok = c("__error").isNull()
    counted = (packs | exact) & (c("__m") == "COUNT")

    def base(name: str) -> Column:
        return F.when(ok, (c(name) * c("__factor")).cast(BASE))

    return (
        steps.withColumn("__error", error)
        .withColumn(
            out,
            F.struct(
                F.when(ok, c("__v")).alias("quantity_value"),
                F.when(ok, c("__low")).alias("quantity_min"),
                F.when(ok, c("__high")).alias("quantity_max"),
                F.when(ok, _lookup(c("__u"), 1)).alias("quantity_unit"),
                base("__v").alias("base_quantity_value"),
                base("__low").alias("base_quantity_min"),
                base("__high").alias("base_quantity_max"),
                F.when(ok, _lookup(c("__u"), 2)).alias("base_unit"),
                F.when(ok & counted, c("__v").cast("int")).alias("package_count"),
                c("__error").alias("error"),
            ),
        )
        .drop("__t", "__m", "__shape", "__low", "__high", "__v", "__u", "__kind", "__factor", "__error")
    )


def quantity_group_ok(exact: Column, low: Column, high: Column, unit: Column) -> Column:
    """Positive values, exact or a full ordered range, and a unit exactly when there is a value."""
    positive = (
        F.coalesce(exact > 0, F.lit(True))
        & F.coalesce(low > 0, F.lit(True))
        & F.coalesce(high > 0, F.lit(True))
    )
    paired = low.isNull() == high.isNull()
    exclusive = exact.isNull() | low.isNull()
    ordered = F.coalesce(high >= low, F.lit(True))
    has_value = exact.isNotNull() | low.isNotNull()
    return positive & paired & exclusive & ordered & (has_value == unit.isNotNull())
