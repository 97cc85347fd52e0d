"""Text, money, quantity and identity functions over documents, line items and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.functions import identity, money, text, urls, vocab
from pricestrata.functions.quantity import quantity_group_ok, to_base, unit_measure, with_quantity
from pricestrata.operators import rules
from pricestrata.queries import query
from pricestrata.session import spread

c = F.col

WS = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
    r"\x{205f}\x{3000}]"
)


def sql_squeeze(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def sql_compact(e: str) -> str:
    return f"regexp_replace({e}, '{WS}+', '', 'g')"


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def sql_map(pairs: dict[str, str], key: str) -> str:
    body = ", ".join(f"'{k}': '{v}'" for k, v in pairs.items())
    return f"MAP {{{body}}}[{key}]"


def sql_token(e: str) -> str:
    return f"regexp_replace(CAST({e} AS VARCHAR), '\\.?0+$', '')"


@query(
    "normalized_text",
    "FN-01 FN-03 FN-04",
    f"""SELECT doc_id, sha256({sql_squeeze('text')}) AS normalized_hash,
          length({sql_compact('text')}) AS compact_length,
          sha256(nullif({sql_strip('text')}, '')) AS stripped_hash FROM documents""",
)
def normalized_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(bind.frame(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        identity.sha256(text.normalize_text(c("text"))).alias("normalized_hash"),
        F.length(text.compact(c("text"))).cast("bigint").alias("compact_length"),
        identity.sha256(text.blank_to_null(c("text"))).alias("stripped_hash"),
    )


_CAPACITY = bind.pick(
    "p_partkey", ["{n} tb", "{n} G B", "１２８ＧＢ", "{n}.5TB", "{n} mb", " {n}  gb ", "name"]
)
bind.VIEWS["capacity_texts"] = (
    "SELECT p_partkey, replace(replace("
    + _CAPACITY.replace("{n}", "@")
    + ", '@', CAST(p_size AS STRING)), 'name', p_name) AS text FROM {part}"
)


@query(
    "capacity_texts",
    "FN-02",
    ctes(
        "capacity_texts",
        extra=f"""n AS (SELECT *, {sql_squeeze("translate(text, '０１２３４５６７８９ＧＢ', '0123456789GB')")} AS t
                  FROM capacity_texts)""",
    )
    + """SELECT p_partkey, CASE WHEN regexp_full_match(upper(replace(t, ' ', '')),
           '[0-9]+(\\.[0-9]+)?(GB|TB)') THEN upper(replace(t, ' ', '')) ELSE t END AS capacity
         FROM n""",
)
def capacity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.frame(spark, sf_dir, "capacity_texts").select(
        "p_partkey", text.capacity(c("text")).alias("capacity")
    )


_NUM = r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{1,2})?"
_MONEY_RE = rf"(?i)(?:RMB|CNY|[¥￥]){WS}*{_NUM}|{_NUM}{WS}*元"


def sql_amount(src: str, txt: str, label: str, prefix: str) -> str:
    """CTEs ending in {prefix}2 with {prefix}_status and {prefix}_amount."""
    terms = "|".join(t.replace("+", r"\+") for t in vocab.CONDITIONAL_TERMS)
    return f"""
{prefix}1 AS (
  SELECT *, {sql_strip(f"({label}) || ' ' || ({txt})")} AS {prefix}_s, {sql_strip(txt)} AS {prefix}_p FROM {src}),
{prefix}1b AS (
  SELECT *, list_distinct(list_transform(
    CASE WHEN len(regexp_extract_all({prefix}_s, '{_MONEY_RE}')) > 0
           THEN regexp_extract_all({prefix}_s, '{_MONEY_RE}')
         WHEN regexp_full_match({prefix}_p, '{_NUM}') THEN [{prefix}_p] ELSE [] END,
    lambda x: CAST(regexp_replace(x, '[^0-9.]', '', 'g') AS DECIMAL(18,2)))) AS {prefix}_l
  FROM {prefix}1),
{prefix}2 AS (
  SELECT *, CASE WHEN ({txt}) IS NULL THEN NULL
    WHEN regexp_matches({prefix}_s, '{terms}|[0-9](?:{WS}*元)?{WS}*起') THEN 'CONDITIONAL'
    WHEN len({prefix}_l) > 1 THEN 'AMBIGUOUS'
    WHEN len({prefix}_l) = 1 AND {prefix}_l[1] > 0 THEN 'OK' ELSE 'NO_AMOUNT' END AS {prefix}_status
  FROM {prefix}1b)"""


def sql_otype(txt: str, label: str) -> str:
    return f"""CASE WHEN contains(({label}) || ({txt}), '划线') THEN 'CROSSED_OUT'
      WHEN contains(({label}) || ({txt}), '建议') OR contains(({label}) || ({txt}), '零售价')
        THEN 'MSRP' ELSE 'EXPLICIT_ORIGINAL' END"""


@query(
    "money_amounts",
    "FN-05 FN-06 FN-07",
    ctes("money_texts", extra=sql_amount("money_texts", "text", "label", "a"))
    + f"""SELECT l_orderkey, l_linenumber, text, label, a_status AS status,
            CASE WHEN a_status = 'OK' THEN a_l[1] END AS amount,
            {sql_otype('text', 'label')} AS original_type,
            a_status = 'CONDITIONAL' AS conditional FROM a2""",
)
def money_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(bind.frame(spark, sf_dir, "money_texts"))
    return money.with_amount(rows, "m", c("text"), c("label")).select(
        "l_orderkey", "l_linenumber", "text", "label", "m.status", "m.amount",
        money.original_type(c("text"), c("label")).alias("original_type"),
        (c("m.status") == "CONDITIONAL").alias("conditional"),
    )


@query(
    "price_pairs",
    "FN-08",
    ctes(
        "money_texts",
        extra=sql_amount("money_texts", "text", "'现价'", "a")
        + ","
        + sql_amount("a2", "original_text", "label", "b"),
    )
    + f"""SELECT l_orderkey, l_linenumber, text, original_text,
            CASE WHEN a_status = 'OK' THEN a_l[1] END AS current_price,
            CASE WHEN keep THEN CASE WHEN b_status = 'OK' THEN b_l[1] END END AS original_price,
            CASE WHEN keep THEN {sql_otype('original_text', 'label')} ELSE 'NONE' END
              AS original_price_type,
            CASE WHEN b_status != 'OK' THEN b_status WHEN a_status != 'OK' THEN a_status END AS error
          FROM (SELECT *, original_text IS NOT NULL AND
                  CASE WHEN a_status = 'OK' THEN a_l[1] END IS DISTINCT FROM
                  CASE WHEN b_status = 'OK' THEN b_l[1] END AS keep FROM b2)""",
)
def price_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(bind.frame(spark, sf_dir, "money_texts"))
    return money.with_pair(
        rows, "pair", c("original_text"), c("label"), c("text"), F.lit("现价")
    ).select("l_orderkey", "l_linenumber", "text", "original_text", "pair.*")


@query(
    "agreeing_amounts",
    "FN-09",
    ctes(
        "money_texts",
        extra="raws AS (SELECT *, CASE l_partkey % 4 WHEN 0 THEN NULL WHEN 3 THEN '8' || p ELSE p END AS raw FROM money_texts),"
        + sql_amount("raws", "raw", "''", "a")
        + ","
        + sql_amount("a2", "original_text", "''", "b"),
    )
    + """SELECT l_orderkey, l_linenumber, raw, original_text, error,
           CASE WHEN error IS NULL THEN coalesce(raw, original_text) END AS text
         FROM (SELECT *, CASE WHEN raw IS NULL OR original_text IS NULL THEN NULL
                 WHEN a_status != 'OK' THEN a_status WHEN b_status != 'OK' THEN b_status
                 WHEN a_l[1] != b_l[1] THEN 'AMOUNT_MISMATCH' END AS error FROM b2)""",
)
def agreeing_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (
        F.when(c("l_partkey") % 4 == 0, None)
        .when(c("l_partkey") % 4 == 3, F.concat(F.lit("8"), c("p")))
        .otherwise(c("p"))
    )
    rows = spread(bind.frame(spark, sf_dir, "money_texts")).withColumn("raw", raw)
    return money.with_agreement(rows, "a", c("raw"), c("original_text")).select(
        "l_orderkey", "l_linenumber", "raw", "original_text", "a.*"
    )


def sql_units(field: int, token: str) -> str:
    return sql_map({k: v[field] for k, v in vocab.UNITS.items()}, token)


def sql_quantity(src: str, txt: str, measure: str) -> str:
    """CTEs ending in q9 with the parsed quantity columns."""
    num, unit = r"([0-9]+(?:\.[0-9]+)?)", "([A-Z]+|[一-鿿]+)"
    return f"""
q1 AS (SELECT *, upper({sql_compact(txt)}) AS t, {measure} AS msr FROM {src}),
q2 AS (SELECT *,
  regexp_extract(t, '^([0-9]+)(?:盒|包|袋|板)(?:\\*|X|×)([0-9]+)(枚|个|只|PIECE|PCS|PC)$', ['a', 'b', 'u']) AS p,
  regexp_extract(t, '^{num}(?:-|~|～|至){num}{unit}$', ['a', 'b', 'u']) AS r,
  regexp_extract(t, '^{num}{unit}$', ['a', 'u']) AS e FROM q1),
q3 AS (SELECT *, CASE WHEN p.u != '' THEN 'P' WHEN r.u != '' THEN 'R' WHEN e.u != '' THEN 'E' END AS shape,
  CASE WHEN p.u != '' THEN 'PIECE' WHEN r.u != '' THEN r.u WHEN e.u != '' THEN e.u END AS tok,
  CASE WHEN p.u != '' THEN CAST(TRY_CAST(p.a AS BIGINT) * TRY_CAST(p.b AS BIGINT) AS DECIMAL(20,6))
       WHEN e.u != '' THEN TRY_CAST(e.a AS DECIMAL(20,6)) END AS v,
  CASE WHEN r.u != '' THEN TRY_CAST(r.a AS DECIMAL(20,6)) END AS lo,
  CASE WHEN r.u != '' THEN TRY_CAST(r.b AS DECIMAL(20,6)) END AS hi FROM q2),
q4 AS (SELECT *, CAST({sql_units(3, 'tok')} AS DECIMAL(4,3)) AS factor,
  {sql_units(0, 'tok')} AS kind, {sql_units(1, 'tok')} AS canon, {sql_units(2, 'tok')} AS bu FROM q3),
q5 AS (SELECT *, CASE WHEN t IS NULL OR t = '' THEN 'BLANK' WHEN shape IS NULL THEN 'UNSUPPORTED'
   WHEN shape = 'P' AND msr != 'COUNT' THEN 'MEASURE_MISMATCH'
   WHEN shape = 'R' AND (lo <= 0 OR hi <= 0) THEN 'NOT_POSITIVE'
   WHEN shape = 'R' AND hi < lo THEN 'RANGE_REVERSED'
   WHEN shape != 'R' AND v <= 0 THEN 'NOT_POSITIVE'
   WHEN shape = 'E' AND msr = 'COUNT' AND v != floor(v) THEN 'NOT_WHOLE'
   WHEN kind IS NULL THEN 'UNIT_UNKNOWN' WHEN kind != msr THEN 'MEASURE_MISMATCH' END AS q_error FROM q4),
q9 AS (SELECT *,
  CASE WHEN q_error IS NULL THEN v END AS quantity_value,
  CASE WHEN q_error IS NULL THEN lo END AS quantity_min,
  CASE WHEN q_error IS NULL THEN hi END AS quantity_max,
  CASE WHEN q_error IS NULL THEN canon END AS quantity_unit,
  CASE WHEN q_error IS NULL THEN CAST(v * factor AS DECIMAL(29,9)) END AS base_quantity_value,
  CASE WHEN q_error IS NULL THEN CAST(lo * factor AS DECIMAL(29,9)) END AS base_quantity_min,
  CASE WHEN q_error IS NULL THEN CAST(hi * factor AS DECIMAL(29,9)) END AS base_quantity_max,
  CASE WHEN q_error IS NULL THEN bu END AS base_unit,
  CASE WHEN q_error IS NULL AND msr = 'COUNT' AND shape != 'R' THEN CAST(v AS INT) END AS package_count
  FROM q5)"""


_Q = (
    "quantity_value, quantity_min, quantity_max, quantity_unit, base_quantity_value,"
    " base_quantity_min, base_quantity_max, base_unit, package_count"
)


@query(
    "quantity_parse",
    "FN-10 FN-11",
    ctes("quantity_texts", extra=sql_quantity("quantity_texts", "text", "measure"))
    + f"SELECT l_orderkey, l_linenumber, text, measure, {_Q}, q_error AS error FROM q9",
)
def quantity_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(bind.frame(spark, sf_dir, "quantity_texts"))
    return with_quantity(rows, "q", c("text"), c("measure")).select(
        "l_orderkey", "l_linenumber", "text", "measure", "q.*"
    )


@query(
    "unit_conversion",
    "FN-11",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(20,6)) AS q,
          {bind.pick('l_partkey', [*vocab.UNITS, '磅'])} AS token FROM lineitem)
        SELECT l_orderkey, l_linenumber, token, {sql_units(0, 'token')} AS measure,
          CAST(q * CAST({sql_units(3, 'token')} AS DECIMAL(4,3)) AS DECIMAL(29,9)) AS base FROM t""",
)
def unit_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.expr(bind.pick("l_partkey", [*vocab.UNITS, "磅"]))
    return (
        bind.frame(spark, sf_dir, "lineitem")
        .withColumn("token", token)
        .select(
            "l_orderkey", "l_linenumber", "token", unit_measure(c("token")).alias("measure"),
            to_base(c("l_quantity"), c("token")).alias("base"),
        )
    )


@query(
    "quantity_groups",
    "RUL-03",
    """WITH t AS (SELECT l_orderkey, l_linenumber,
          CASE WHEN l_partkey % 4 < 2 THEN CAST(l_quantity - 5 AS DECIMAL(20,6)) END AS exact,
          CASE WHEN l_partkey % 4 IN (1, 2) THEN CAST(l_quantity AS DECIMAL(20,6)) END AS low,
          CASE WHEN l_partkey % 5 IN (1, 2) THEN CAST(l_suppkey AS DECIMAL(20,6)) END AS high,
          CASE WHEN l_suppkey % 3 > 0 THEN 'KG' END AS unit FROM lineitem)
        SELECT l_orderkey, l_linenumber, NOT (
            coalesce(exact <= 0, false) OR coalesce(low <= 0, false) OR coalesce(high <= 0, false)
            OR (low IS NULL AND high IS NOT NULL) OR (low IS NOT NULL AND high IS NULL)
            OR (exact IS NOT NULL AND low IS NOT NULL) OR coalesce(high < low, false)
            OR (coalesce(exact, low) IS NOT NULL AND unit IS NULL)
            OR (coalesce(exact, low) IS NULL AND unit IS NOT NULL)) AS consistent FROM t""",
)
def quantity_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = "decimal(20,6)"
    df = bind.frame(spark, sf_dir, "lineitem")
    exact = F.when(c("l_partkey") % 4 < 2, (c("l_quantity") - 5).cast(q))
    low = F.when((c("l_partkey") % 4).isin(1, 2), c("l_quantity").cast(q))
    high = F.when((c("l_partkey") % 5).isin(1, 2), c("l_suppkey").cast(q))
    unit = F.when(c("l_suppkey") % 3 > 0, "KG")
    return df.select(
        "l_orderkey", "l_linenumber", quantity_group_ok(exact, low, high, unit).alias("consistent")
    )


@query(
    "alias_codes",
    "FN-12",
    ctes("fresh_rows")
    + "SELECT p_partkey, "
    + ", ".join(
        f"{sql_map(words, 'upper(' + sql_compact(name) + ')')} AS {name}_code"
        for name, words in vocab.ALIASES.items()
    )
    + " FROM fresh_rows",
)
def alias_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.frame(spark, sf_dir, "fresh_rows").select(
        "p_partkey", *[rules.alias_code(n, c(n)).alias(f"{n}_code") for n in vocab.ALIASES]
    )


@query(
    "source_tokens",
    "FN-13 FN-15",
    ctes("fresh_rows")
    + f"""SELECT p_partkey,
            nullif(CASE WHEN regexp_full_match({sql_compact('origin')}, '[\\x00-\\x7f]*')
              THEN upper({sql_compact('origin')}) ELSE {sql_compact('origin')} END, '') AS origin_token,
            upper(regexp_replace({sql_strip('p_name')}, '{WS}+', '_', 'g')) AS name_token,
            nullif({sql_squeeze('source_specification')}, '') AS specification_text,
            CASE WHEN regexp_full_match(upper(regexp_replace({sql_strip('commodity_code')}, '{WS}+', '_', 'g')),
              '[A-Z][A-Z0-9_]{{1,63}}') THEN upper(regexp_replace({sql_strip('commodity_code')}, '{WS}+', '_', 'g')) END
              AS commodity_token,
            {sql_map(vocab.QUOTED_UNITS, 'lower(' + sql_compact('quoted_unit') + ')')} AS quoted_unit_code
          FROM fresh_rows JOIN part USING (p_partkey)""",
)
def source_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.frame(spark, sf_dir, "fresh_rows").select(
        "p_partkey",
        text.origin_token(c("origin")).alias("origin_token"),
        text.upper_token(c("commodity_name")).alias("name_token"),
        text.source_text(c("source_specification")).alias("specification_text"),
        text.commodity_code(c("commodity_code")).alias("commodity_token"),
        rules.quoted_unit(c("quoted_unit")).alias("quoted_unit_code"),
    )


@query(
    "decimal_texts",
    "FN-14",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, CASE l_partkey % 4
          WHEN 0 THEN CAST(CAST(l_quantity AS DECIMAL(10,3)) AS VARCHAR)
          WHEN 1 THEN CAST(CAST(l_discount AS DECIMAL(10,4)) AS VARCHAR)
          WHEN 2 THEN CAST(l_partkey AS VARCHAR) ELSE '-' || CAST(l_suppkey AS VARCHAR) END AS raw
          FROM lineitem)
        SELECT l_orderkey, l_linenumber, raw, CASE WHEN CAST(raw AS DECIMAL(18,4)) > 0
          THEN {sql_token('CAST(raw AS DECIMAL(18,4))')} END AS token FROM t""",
)
def decimal_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = c("l_partkey") % 4
    raw = (
        F.when(kind == 0, c("l_quantity").cast("decimal(10,3)").cast("string"))
        .when(kind == 1, c("l_discount").cast("decimal(10,4)").cast("string"))
        .when(kind == 2, c("l_partkey").cast("string"))
        .otherwise(F.concat(F.lit("-"), c("l_suppkey").cast("string")))
    )
    return (
        bind.frame(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", raw.alias("raw"))
        .withColumn("token", text.positive_decimal_text(c("raw")))
    )


@query(
    "region_mapping",
    "FN-16",
    f"""WITH t AS (SELECT c_custkey,
          {bind.pick('c_custkey', [*vocab.REGION_CODES, '北京', '火星'])} AS region_name FROM customer)
        SELECT c_custkey, region_name, {sql_map(vocab.REGION_CODES, 'region_name')} AS region_code,
          CASE WHEN {sql_map(vocab.REGION_CODES, 'region_name')} IS NOT NULL THEN 'PROVINCE' END
            AS region_scope,
          CASE WHEN {sql_map(vocab.REGION_CODES, 'region_name')} IS NULL
            THEN 'REGION_MAPPING_MISSING' END AS error FROM t""",
)
def region_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricestrata.sources.seeds import regions

    name = F.expr(bind.pick("c_custkey", [*vocab.REGION_CODES, "北京", "火星"]))
    known = c("region_code").isNotNull()
    return (
        bind.frame(spark, sf_dir, "customer")
        .select("c_custkey", name.alias("region_name"))
        .join(F.broadcast(regions(spark)), "region_name", "left")
        .withColumn("region_scope", F.when(known, "PROVINCE"))
        .withColumn("error", F.when(~known, "REGION_MAPPING_MISSING"))
    )


@query(
    "published_prices",
    "FN-38 FN-39",
    """WITH t AS (SELECT l_orderkey, l_linenumber,
          CASE l_partkey % 4 WHEN 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
            WHEN 1 THEN '0' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
            WHEN 2 THEN CAST(CAST(l_tax AS DECIMAL(18,3)) AS VARCHAR)
            ELSE CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) END AS price_text,
          CASE l_suppkey % 4 WHEN 0 THEN '0.00' WHEN 1 THEN '0.0#' WHEN 2 THEN '0.000'
            ELSE 'General' END AS number_format,
          CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
            || CAST(l_partkey % 10 AS VARCHAR) AS cell
          FROM lineitem)
       SELECT l_orderkey, l_linenumber, price_text, number_format, cell,
         CASE WHEN regexp_full_match(price_text, '(0|[1-9][0-9]*)(\\.[0-9]{1,2})?')
              AND CAST(price_text AS DECIMAL(18,3)) > 0
              THEN CAST(price_text AS DECIMAL(18,2)) END AS strict_price,
         CASE WHEN number_format IN ('0.00', '0.0#')
              THEN CAST(CAST(cell AS DECIMAL(18,3)) AS DECIMAL(18,2)) END AS published_price FROM t""",
)
def published_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    def cents(name: str, scale: int = 2) -> F.Column:
        return c(name).cast(f"decimal(18,{scale})").cast("string")

    kind = c("l_partkey") % 4
    price_text = (
        F.when(kind == 0, cents("l_extendedprice"))
        .when(kind == 1, F.concat(F.lit("0"), cents("l_extendedprice")))
        .when(kind == 2, cents("l_tax", 3))
        .otherwise(cents("l_discount"))
    )
    fmt = F.expr(bind.pick("l_suppkey", ["0.00", "0.0#", "0.000", "General"]))
    cell = F.concat(cents("l_extendedprice"), (c("l_partkey") % 10).cast("string"))
    return (
        bind.frame(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey", "l_linenumber", price_text.alias("price_text"),
            fmt.alias("number_format"), cell.alias("cell"),
        )
        .withColumn("strict_price", money.strict_price(c("price_text")))
        .withColumn("published_price", money.published_price(c("cell"), c("number_format")))
    )


@query(
    "source_days",
    "FN-36",
    """WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day,
          strftime(l_shipdate, '%Y-%m-%d') || '黄瓜批发价格行情（单位：元/公斤）' AS title FROM lineitem)
        SELECT l_orderkey, l_linenumber, title, day AS source_date,
          CAST(day AS TIMESTAMP) - INTERVAL 8 HOUR AS observed_at FROM t""",
)
def source_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit("黄瓜批发价格行情（单位：元/公斤）")
    )
    parts = [
        F.regexp_extract("title", r"^([0-9]{4})-([0-9]{2})-([0-9]{2})", i).cast("int")
        for i in (1, 2, 3)
    ]
    return (
        bind.frame(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", title.alias("title"))
        .withColumn("source_date", F.try_make_date(*parts) if hasattr(F, "try_make_date") else F.make_date(*parts))
        .withColumn("observed_at", identity.source_day_utc(c("source_date")))
    )


@query(
    "url_rules",
    "FN-21 FN-22",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://([^/?#]*)([^?#]*)\\??([^#]*)',
            ['s', 'h', 'p', 'q']) AS u FROM pages)
       SELECT page_id, u.h AS host,
         CASE WHEN u.s != 'https' THEN 'SCHEME'
              WHEN NOT regexp_matches(u.h, '\\.example\\.(com|org)$') THEN 'HOST' END AS verdict,
         CASE WHEN len(regexp_extract_all(u.q, '(?:^|&)page=([0-9]+)', 1)) = 1
              THEN regexp_extract(u.q, '(?:^|&)page=([0-9]+)', 1) END AS page_no,
         nullif(regexp_extract(u.p, '^/[a-z]{2}/([0-9]+)(?:\\.html)?/?$', 1), '') AS article_id
       FROM p""",
)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = urls.host(c("url")).rlike(r"\.example\.(com|org)\z")
    article = F.regexp_extract(urls.path(c("url")), r"^/[a-z]{2}/([0-9]+)(?:\.html)?/?\z", 1)
    return (
        bind.frame(spark, sf_dir, "pages")
        .withColumn("allowed", F.when(known, F.array(urls.host(c("url")))).otherwise(F.array(F.lit(""))))
        .select(
            "page_id",
            urls.host(c("url")).alias("host"),
            urls.url_verdict(c("url"), c("allowed")).alias("verdict"),
            urls.single_query_value(c("url"), "page").alias("page_no"),
            F.when(article != "", article).alias("article_id"),
        )
    )


@query(
    "same_urls",
    "FN-23",
    """WITH t AS (SELECT page_id, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
            || 'a=1&b=2' AS lhs,
          split_part(split_part(url, '#', 1), '?', 1) || '?b=' || CAST(2 + page_id % 2 AS VARCHAR) || '&a=1'
            || CASE WHEN contains(url, '?') THEN '&' || regexp_extract(url, '\\?([^#]*)', 1) ELSE '' END AS rhs
          FROM pages)
       SELECT page_id, page_id % 2 = 0 AS same FROM t""",
)
def same_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = F.split_part("url", F.lit("#"), F.lit(1))
    has_query = F.contains(c("url"), F.lit("?"))
    lhs = F.concat(bare, F.when(has_query, "&").otherwise("?"), F.lit("a=1&b=2"))
    rhs = F.concat(
        F.split_part(bare, F.lit("?"), F.lit(1)),
        F.lit("?b="),
        (2 + c("page_id") % 2).cast("string"),
        F.lit("&a=1"),
        F.when(has_query, F.concat(F.lit("&"), urls.query(c("url")))).otherwise(""),
    )
    return bind.frame(spark, sf_dir, "pages").select(
        "page_id", urls.same_url(lhs, rhs).alias("same")
    )


@query(
    "key_hashes",
    "FN-33 FN-34 FN-40",
    """SELECT page_id, sha256(url) AS url_hash, sha256('["' || url || '","' || CAST(page_id AS VARCHAR) || '"]')
         AS row_hash, regexp_full_match(sha256(html), '[0-9a-f]{64}') AS hash_ok,
         CASE WHEN page_id % 2 = 0 THEN 'P' || CAST(page_id AS VARCHAR)
              ELSE 'PUBLIC_PRICE:' || sha256(url) END AS entity_key FROM pages""",
)
def key_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = c("page_id").cast("string")
    product = F.when(c("page_id") % 2 == 0, F.concat(F.lit("P"), number))
    return bind.frame(spark, sf_dir, "pages").select(
        "page_id",
        identity.sha256(c("url")).alias("url_hash"),
        identity.json_hash(c("url"), number).alias("row_hash"),
        identity.is_sha256(identity.sha256(c("html"))).alias("hash_ok"),
        identity.entity_key(product, c("url")).alias("entity_key"),
    )


@query(
    "code_lists",
    "FN-41",
    """SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(
         string_split(lower(o_orderpriority) || ', ' || o_orderstatus || ', ,' || o_orderstatus, ','),
         lambda x: upper(trim(x))), lambda x: x != ''))), ',') AS codes FROM orders""",
)
def code_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(
        F.lower("o_orderpriority"), F.lit(", "), "o_orderstatus", F.lit(", ,"), "o_orderstatus"
    )
    return bind.frame(spark, sf_dir, "orders").select(
        "o_orderkey", F.array_join(text.code_list(F.split(raw, ",")), ",").alias("codes")
    )
