"""Text normalisation as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Unicode white space plus the four ASCII separators.
WS = r"(?U)[\s\x1c-\x1f]"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(n) for n in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Characters NFKC leaves alone, so rows made only of them never leave the JVM.
_NFKC_SENSITIVE = r"[^\x00-\x7fÀ-ı、。一-鿿]"


@F.pandas_udf(StringType())
def _nfkc_batch(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def nfkc(col: Column) -> Column:
    # Byte and character counts agree for ASCII, which settles most rows without a pattern.
    needs_python = (F.octet_length(col) > F.length(col)) & col.rlike(_NFKC_SENSITIVE)
    return F.when(needs_python, _nfkc_batch(F.when(needs_python, col))).otherwise(col)


@F.pandas_udf(ArrayType(StringType()))
def _nfkc_lists(values: pd.Series) -> pd.Series:
    def each(items: object) -> list[str | None]:
        return [None if v is None else unicodedata.normalize("NFKC", v) for v in items]

    return values.map(each, na_action="ignore")


def nfkc_array(col: Column) -> Column:
    """NFKC of every element; Python UDFs cannot run inside a lambda, so whole arrays go over."""
    needs_python = F.exists(col, lambda v: F.coalesce(v.rlike(_NFKC_SENSITIVE), F.lit(False)))
    return F.when(needs_python, _nfkc_lists(F.when(needs_python, col))).otherwise(col)


def with_normalized_entries(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the entries of a map with lower-cased normalised keys and normalised values.

    A step of its own: the planner refuses a Python UDF in one expression with a lambda.
    """
    return (
        df.withColumn("__k", nfkc_array(F.map_keys(column)))
        .withColumn("__v", nfkc_array(F.map_values(column)))
        .withColumn(
            out,
            F.zip_with(
                "__k",
                "__v",
                lambda k, v: F.struct(F.lower(squeeze(k)).alias("key"), squeeze(v).alias("value")),
            ),
        )
        .drop("__k", "__v")
    )


def plain(df: DataFrame) -> DataFrame:
    """The same rows with plain columns: later steps name a column instead of repeating the text that
    computes it, which the optimizer would otherwise copy into every use."""
    return df.select(F.inline(F.array(F.struct("*"))))


def squeeze(col: Column) -> Column:
    """Collapse white space to single spaces and trim."""
    return F.trim(F.regexp_replace(col, WS + "+", " "))


def compact(col: Column) -> Column:
    """Remove all white space."""
    return F.regexp_replace(col, WS + "+", "")


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only the space character."""
    return F.btrim(col, F.lit(WS_CHARS))


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.when(col.rlike(r"(?U)[^\s\x1c-\x1f]"), strip(col))


def normalize_text(col: Column) -> Column:
    return squeeze(nfkc(col))


def capacity(col: Column) -> Column:
    """``1 tb`` becomes ``1TB``; anything else stays normalised text."""
    return capacity_token(normalize_text(col))


def capacity_token(text: Column) -> Column:
    """The same for text that is already normalised."""
    token = F.replace(F.upper(text), F.lit(" "), F.lit(""))
    return F.when(token.rlike(r"^[0-9]+(\.[0-9]+)?(GB|TB)\z"), token).otherwise(text)


def upper_token(col: Column) -> Column:
    return F.upper(F.regexp_replace(strip(col), WS + "+", "_"))


def origin_token(col: Column) -> Column:
    """White space removed; upper-cased only when the text is plain ASCII."""
    token = compact(col)
    value = F.when(token.rlike(r"^[\x00-\x7f]*\z"), F.upper(token)).otherwise(token)
    return F.when(token != "", value)


def source_text(col: Column) -> Column:
    text = squeeze(col)
    return F.when(text != "", text)


def commodity_code(col: Column) -> Column:
    """Stable ASCII token or NULL."""
    token = upper_token(col)
    return F.when(token.rlike(r"^[A-Z][A-Z0-9_]{1,63}\z"), token)


def decimal_token(col: Column) -> Column:
    """Canonical decimal text: ``80.0`` -> ``80``, ``10`` stays ``10``."""
    text = col.cast("string")
    return F.when(
        F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+\z", "")
    ).otherwise(text)


def positive_decimal_text(col: Column) -> Column:
    """Canonical text of a positive decimal, NULL when not positive or not a number."""
    value = strip(col).try_cast("decimal(38,12)")
    return F.when(value > 0, decimal_token(value))


def code_list(col: Column) -> Column:
    """Trim, upper-case, drop blanks, sort and de-duplicate a list of codes."""
    cleaned = F.transform(col, lambda v: F.upper(strip(v)))
    return F.array_sort(F.array_distinct(F.filter(cleaned, lambda v: v != "")))
