"""Labelled-row sheets: a cell table becomes one record per column, a sheet fails as a whole."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.money import published_price
from pricestrata.functions.text import compact

c = F.col
_NAMES = dict(
    zip(vocab.SHEET_LABELS, ("commodity_group", "commodity_name", "specification", "unit", "price_cell"), strict=True)
)


def _columns(cells: DataFrame, doc: str) -> DataFrame:
    """One row per column of a sheet: its cells by label, and how often each label heads a row in it.

    The pivot is an aggregate over known labels. The label of a cell is the first cell of its row. Cells are
    shuffled by sheet, once: the rows, the columns and the sheets themselves are then in place.
    """
    mark = F.when((c("col_no") == 0) & c(doc).isNotNull() & c("row_no").isNotNull(), compact(c("value")))
    known = F.when(c("label").isin(*vocab.SHEET_LABELS), c("label"))
    heads = F.collect_set(known).over(Window.partitionBy(doc, "row_no"))
    placed = cells.select(doc, "row_no", "col_no", "value", "number_format").repartition(doc).withColumn("label", mark)
    under = F.when((c("col_no") >= 2) & c(doc).isNotNull() & c("row_no").isNotNull(), heads)
    # A cell without a label stays, as a sheet without any is a sheet with a fault.
    rows = placed.withColumn("heads", under).select(
        doc, "col_no", "value", "number_format", F.explode_outer("heads").alias("head")
    )
    first = F.when(c("col_no") == 0, compact(c("value")))
    return rows.groupBy(doc, "col_no").agg(
        *[
            F.max(F.when(c("head") == name, c("value") if name == "均价" else compact(c("value")))).alias(alias)
            for name, alias in _NAMES.items()
        ],
        F.max(F.when(c("head") == "均价", c("number_format"))).alias("number_format"),
        *[F.count_if(first == name).alias(f"n_{alias}") for name, alias in _NAMES.items()],
    )


def sheet_prices(cells: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Every sheet times the whitelisted commodities, with matches, price and errors.

    A sheet fails as a whole: ``error_code`` is its structure error, or else the first error of
    its commodities in list order, on all of its rows; ``row_error`` is the row's own. A sheet is one row
    until the end, so commodities are looked up without a join.
    """
    dims = ["commodity_group", "commodity_name", "specification", "unit"]
    entries = vocab.CITY_COMMODITIES
    columns = _columns(cells, doc).withColumn("price", published_price(c("price_cell"), c("number_format")))
    hit = [
        F.coalesce(reduce(and_, [c(d) == v for d, v in zip(dims, row[1:], strict=True)]), F.lit(False)) for row in entries
    ]
    whole = columns.groupBy(doc).agg(
        *[F.sum(f"n_{alias}").alias(f"n_{alias}") for alias in _NAMES.values()],
        *[F.count_if(h).alias(f"matches_{i}") for i, h in enumerate(hit)],
        *[F.min(F.when(h, c("price"))).alias(f"price_{i}") for i, h in enumerate(hit)],
    )
    # Every label heads exactly one row of a sheet.
    ok = reduce(and_, [c(f"n_{alias}") == 1 for alias in _NAMES.values()])

    def own(i: int) -> Column:
        return F.when(c(f"matches_{i}") != 1, "COMMODITY_MAPPING_MISSING").when(
            c(f"price_{i}").isNull(), "PRICE_VALUE_INVALID"
        )

    error = F.coalesce(F.when(~ok, "DATASET_STRUCTURE_CHANGED"), *[own(i) for i in range(len(entries))])
    rows = F.array(*[
        F.struct(
            F.lit(row[0]).alias("commodity_code"), c(f"matches_{i}").alias("matches"), c(f"price_{i}").alias("price"),
            own(i).alias("row_error"),
        )
        for i, row in enumerate(entries)
    ])
    return whole.select(doc, error.alias("error_code"), F.inline(rows)).select(
        doc, "commodity_code", "matches", "price", "row_error", "error_code"
    )
