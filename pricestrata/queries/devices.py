"""Device wording, specifications and identity rules over parts and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes, pick
from pricestrata.functions import device, identity, vocab
from pricestrata.functions.text import normalize_text, with_normalized_entries
from pricestrata.operators import rules
from pricestrata.queries import query
from pricestrata.session import spread
from pricestrata.queries.scalars import (
    WS,
    sql_amount,
    sql_compact,
    sql_map,
    sql_otype,
    sql_quantity,
    sql_squeeze,
    sql_strip,
    sql_token,
)

c = F.col
BRANDS4 = ["HUAWEI", "XIAOMI", "OPPO", "VIVO"]


def _numbered(expr: str) -> str:
    return f"replace({expr}, '@', CAST(p_size AS STRING))"


bind.VIEWS["device_names"] = (
    f"SELECT p_partkey, p_name, p_size, {pick('p_partkey', BRANDS4)} AS brand, "
    + _numbered(
        pick(
            "p_partkey",
            ["HUAWEI MatePad @", "HUAWEI Mate @", "HUAWEI WATCH @ 表带", "Xiaomi @ Pro", "小米 @",
             "小米平板 @", "REDMI Note @", "OPPO  Find X@", "OPPO Care+ @", "OPPO Watch @",
             "vivo X@", "vivo Pad@", "iQOO @", "荣耀 @", "huawei matebook @",
             "HUAWEI 擎云台式 @", "vivo S@ 充电器", "Xiaomi Book @", "oppo pad @"],
        )
    )
    + " AS name, "
    + pick(
        "p_partkey",
        ["已下架", "立即购买", "即将上市 预约", "现货", "预售中", "缺货 立即购买", "到货通知",
         "商品已下架", "预约", "有现货", "暂无供应", "plain words", "已售罄"],
    )
    + " AS stock_text, "
    + pick("p_size", ["APPLE", *BRANDS4])
    + " AS stock_brand, "
    + _numbered(
        pick(
            "p_partkey",
            ["@GB+256GB", "Pro @ GB / 1 TB 典藏版", "@gb + 512gb", "标准版", " ", "至尊 @GB+1TB/16",
             "@GB/256GB"],
        )
    )
    + " AS version FROM {part}"
)


def _sql_category(brand: str) -> str:
    r = vocab.NAME_RULES[brand]
    cased = vocab.CASED_EXCLUSIONS.get(brand, ())
    tests = [f"contains({'t' if w in cased else 'u'}, '{w}')" for w in r["exclude"]]
    tests += [f"starts_with(u, '{w}')" for w in r.get("exclude_start", ())]
    arms = " ".join(
        f"WHEN regexp_matches(u, '^(?:{p})') THEN '{code}'" for code, p in r["categories"]
    )
    return f"CASE WHEN {' OR '.join(tests)} THEN NULL {arms} END"


@query(
    "name_categories",
    "FN-19",
    ctes(
        "device_names",
        extra=f"n AS (SELECT *, {sql_squeeze('name')} AS t, upper({sql_squeeze('name')}) AS u FROM device_names)",
    )
    + "SELECT p_partkey, brand, name, CASE brand "
    + " ".join(f"WHEN '{b}' THEN {_sql_category(b)}" for b in BRANDS4)
    + " END AS category_code FROM n",
)
def name_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.settled(bind.frame(spark, sf_dir, "device_names"))
    return device.with_category(rows, "category_code", c("brand"), c("name")).select(
        "p_partkey", "brand", "name", "category_code"
    )


def _sql_stock(brand: str) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains(stock_text, '{w}')" for w in words) + f" THEN '{state}'"
        for state, words in vocab.AVAILABILITY_TERMS[brand]
    )
    return f"CASE {arms} ELSE '{vocab.AVAILABILITY_DEFAULT.get(brand, 'UNKNOWN')}' END"


@query(
    "stock_wording",
    "FN-17",
    ctes("device_names")
    + "SELECT p_partkey, stock_brand, stock_text, CASE stock_brand "
    + " ".join(f"WHEN '{b}' THEN {_sql_stock(b)}" for b in ["APPLE", *BRANDS4])
    + " END AS availability FROM device_names",
)
def stock_wording(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.frame(spark, sf_dir, "device_names").select(
        "p_partkey", "stock_brand", "stock_text",
        device.availability_by_brand(c("stock_brand"), c("stock_text")).alias("availability"),
    )


@query(
    "stock_flags",
    "FN-18",
    """SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_returnflag = 'R' OR l_partkey % 3 = 0 THEN 'OFF_SHELF'
              WHEN l_linestatus = 'O' OR l_suppkey % 4 = 0 THEN 'OUT_OF_STOCK'
              WHEN l_suppkey % 4 = 1 AND l_partkey % 3 = 1 THEN 'ON_SALE' ELSE 'UNKNOWN' END AS by_flags,
         CASE WHEN l_linenumber = 1 THEN 'COMING_SOON' WHEN l_quantity - 10 > 0 THEN 'ON_SALE'
              ELSE 'UNKNOWN' END AS by_inventory FROM lineitem""",
)
def stock_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.frame(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        device.availability_from_flags(
            c("l_returnflag") == "R", c("l_linestatus") == "O", c("l_partkey") % 3,
            c("l_suppkey") % 4,
        ).alias("by_flags"),
        device.availability_from_inventory(
            c("l_linenumber"), c("l_quantity").cast("int") - 10
        ).alias("by_inventory"),
    )


_MEM = r"(?i)([0-9]+\s*GB)\s*(?:\+|/)\s*([0-9]+\s*(?:GB|TB))"


@query(
    "version_parts",
    "FN-20",
    ctes(
        "device_names",
        extra=f"""v AS (SELECT *, {sql_squeeze('version')} AS t FROM device_names),
w AS (SELECT *, regexp_matches(t, '{_MEM}') AS hit,
        regexp_extract(t, '^(.*?){_MEM}(.*)$', ['before', 'm', 'cap', 'after']) AS x FROM v)""",
    )
    + f"""SELECT p_partkey, version,
            CASE WHEN hit THEN upper(replace(x.m, ' ', '')) END AS memory,
            CASE WHEN hit THEN upper(replace(x.cap, ' ', '')) END AS capacity,
            CASE WHEN hit THEN nullif({sql_squeeze("trim(x.before, ' /+') || ' ' || trim(x.after, ' /+')")}, '')
                 ELSE nullif(t, '') END AS edition,
            CASE WHEN regexp_matches(t, '{_MEM.replace("(?:" + chr(92) + "+|/)", chr(92) + "+")}')
                 THEN upper(replace(x.m, ' ', '')) END AS strict_memory
          FROM w""",
)
def version_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        bind.frame(spark, sf_dir, "device_names")
        .withColumn("t", normalize_text(c("version")))
        .withColumn("v", device.split_version(c("t")))
        .select(
            "p_partkey", "version", "v.memory", "v.capacity", "v.edition",
            device.split_version(c("t"), "OPPO")["memory"].alias("strict_memory"),
        )
    )


# Parts as SKU rows of the five malls: raw dimensions, some blank, repeated or mutable.
bind.VIEWS["device_rows"] = (
    "SELECT p_partkey, 'P' || CAST(p_partkey - p_partkey % 3 AS STRING) AS product_id, "
    "CASE WHEN p_partkey % 4 <> 1 THEN 'S' || CAST(p_partkey AS STRING) END AS sku_id, "
    "p_brand AS brand, p_name, p_size, "
    + pick("p_partkey", ["PHONE", "TABLET", "LAPTOP", "WATCH", "FRIDGE", "PHONE", "DESKTOP"])
    + " AS category_code, "
    + pick("p_partkey", ["RETAIL_OFFER"] * 10 + ["MARKET_AVERAGE"])
    + " AS price_nature, "
    + pick("p_partkey", ["深空 黑", " black ", None, "　", "White"])
    + " AS color, "
    + _numbered(pick("p_partkey", ["@ gb", None, "@TB", "", "大", None, None]))
    + " AS capacity, "
    + _numbered(pick("p_size", ["16GB", None, " 8 gb", None]))
    + " AS memory, "
    + pick("p_partkey", [None, "Chip", "chip", "Price", "款式", "  "])
    + " AS extra_key, p_type AS extra_value, "
    + pick("p_partkey", [None, None, "chip", None, "band"])
    + " AS second_key FROM {part}"
)


def _null_blank(e: str) -> str:
    return f"nullif({sql_squeeze(e)}, '')"


def _capacity_sql(e: str) -> str:
    squeezed = sql_squeeze(e)
    bare = f"upper(replace({squeezed}, ' ', ''))"
    return (
        f"nullif(CASE WHEN regexp_full_match({bare}, '[0-9]+(\\.[0-9]+)?(GB|TB)') THEN {bare}"
        f" ELSE {squeezed} END, '')"
    )


_SPEC = f"""
f AS (SELECT *, {_null_blank('color')} AS f_color, {_capacity_sql('capacity')} AS f_capacity,
        {_capacity_sql('memory')} AS f_memory,
        list_filter([extra_key, second_key], lambda x: x IS NOT NULL) AS raw_keys FROM device_rows),
g AS (SELECT *, list_transform(raw_keys, lambda x: lower({sql_squeeze('x')})) AS keys FROM f),
h AS (SELECT *,
    CASE WHEN list_contains(keys, '') THEN 'BLANK_DIMENSION'
         WHEN len(list_distinct(keys)) < len(keys) THEN 'REPEATED_DIMENSION'
         WHEN list_contains(keys, 'price') THEN 'MUTABLE_DIMENSION'
         WHEN len(keys) = 0 AND coalesce(f_color, f_capacity, f_memory) IS NULL
           THEN 'NOTHING_PROVEN' END AS spec_error FROM g),
j AS (SELECT *, CASE WHEN spec_error IS NULL THEN '{{' || array_to_string(list_filter([
    CASE WHEN len(keys) > 0 THEN '"attributes":{{' || array_to_string(list_transform(list_sort(keys),
      lambda k: '"' || k || '":"' || extra_value || '"'), ',') || '}}' END,
    '"capacity":"' || f_capacity || '"', '"color":"' || f_color || '"',
    '"memory":"' || f_memory || '"'], lambda x: x IS NOT NULL), ',') || '}}' END AS identity_json FROM h),
l AS (SELECT *, '["' || product_id || '","' || CASE WHEN sku_id IS NULL THEN 'spec","' || sha256(identity_json)
      ELSE 'sku","' || sku_id END || '"]' AS expected_key FROM j)"""


def _device_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spread(bind.settled(bind.frame(spark, sf_dir, "device_rows")))
    pairs = F.filter(
        F.array(
            F.struct(c("extra_key").alias("key"), c("extra_value").alias("value")),
            F.struct(c("second_key").alias("key"), c("extra_value").alias("value")),
        ),
        lambda e: e["key"].isNotNull(),
    )
    same = c("extra_key").eqNullSafe(c("second_key"))
    # A map cannot hold one key twice; the repeated label arrives with a trailing blank instead.
    second = F.when(same & c("second_key").isNotNull(), F.concat("second_key", F.lit(" ")))
    rows = df.withColumn("second_key", F.coalesce(second, c("second_key"))).withColumns(
        {
            "spec_fields": F.create_map(
                F.lit("color"), c("color"), F.lit("capacity"), c("capacity"),
                F.lit("memory"), c("memory"),
            ),
            "spec_attributes": F.map_from_entries(pairs),
        }
    )
    return with_normalized_entries(rows, "spec_attributes", "entries")


@query(
    "device_specifications",
    "FN-27 FN-30",
    ctes("device_rows", extra=_SPEC)
    + "SELECT p_partkey, spec_error, identity_json, sha256(identity_json) AS fingerprint FROM j",
)
def device_specifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {n: F.try_element_at(c("spec_fields"), F.lit(n)) for n in vocab.SPEC_FIELDS}
    rows = device.with_specification(_device_frame(spark, sf_dir), "s", fields, c("entries"))
    return rows.select(
        "p_partkey", c("s.error").alias("spec_error"), c("s.json").alias("identity_json"),
        identity.sha256(c("s.json")).alias("fingerprint"),
    )


@query(
    "map_fingerprints",
    "FN-30",
    f"""SELECT p_partkey, sha256('{{"brand":"' || p_brand || '","size":"' || CAST(p_size AS VARCHAR) ||
          '","type":"' || {sql_squeeze("'  ' || p_type || '  x '")} || '"}}') AS fingerprint FROM part""",
)
def map_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = F.create_map(
        F.lit("Type"), F.concat(F.lit("  "), c("p_type"), F.lit("  x ")),
        F.lit(" SIZE "), c("p_size").cast("string"),
        F.lit("BRAND"), F.lit("overwritten"),
        F.lit("Brand"), c("p_brand"),
    )
    rows = bind.frame(spark, sf_dir, "part").select("p_partkey", attributes.alias("attributes"))
    return with_normalized_entries(rows, "attributes", "entries").select(
        "p_partkey", identity.spec_fingerprint(c("entries")).alias("fingerprint")
    )


@query(
    "device_keys",
    "FN-28 FN-29",
    ctes("device_rows", extra=_SPEC)
    + """SELECT p_partkey, sha256('["' || upper(brand) || '","HUAWEI_CN_WEB","' || product_id || '"]') AS item_key,
           expected_key AS listing_key, sha256(expected_key) AS listing_key_hash FROM l""",
)
def device_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {n: F.try_element_at(c("spec_fields"), F.lit(n)) for n in vocab.SPEC_FIELDS}
    rows = device.with_specification(_device_frame(spark, sf_dir), "s", fields, c("entries"))
    return (
        rows.withColumn("listing_key", device.listing_key(c("product_id"), c("sku_id"), c("s.json")))
        .select(
            "p_partkey",
            device.item_key(c("brand"), F.lit(" huawei_cn_web "), c("product_id")).alias("item_key"),
            "listing_key",
            identity.sha256(c("listing_key")).alias("listing_key_hash"),
        )
    )


@query(
    "device_identity_rule",
    "RUL-09",
    ctes(
        "device_rows",
        extra=_SPEC
        + """,
m AS (SELECT *, CASE WHEN category_code NOT IN ('PHONE', 'TABLET', 'LAPTOP', 'DESKTOP', 'WATCH')
        THEN 'DEVICE_CATEGORY_UNSUPPORTED'
      WHEN price_nature != 'RETAIL_OFFER' THEN 'DEVICE_SOURCE_IDENTITY_INVALID'
      WHEN spec_error IS NOT NULL THEN 'DEVICE_SPECIFICATION_UNPROVEN'
      WHEN p_partkey % 17 = 0 THEN 'DEVICE_LISTING_KEY_MISMATCH' END AS identity_code FROM l)""",
    )
    + """SELECT p_partkey, identity_code, CASE WHEN identity_code IS NULL THEN 'ACCEPTED'
           ELSE 'REVIEW_REQUIRED' END AS identity_status FROM m""",
)
def device_identity_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {n: F.try_element_at(c("spec_fields"), F.lit(n)) for n in vocab.SPEC_FIELDS}
    rows = (
        device.with_specification(_device_frame(spark, sf_dir), "s0", fields, c("entries"))
        .withColumn("k0", device.listing_key(c("product_id"), c("sku_id"), c("s0.json")))
        .withColumn(
            "listing_key", F.when(c("p_partkey") % 17 == 0, F.concat("k0", F.lit("x"))).otherwise(c("k0"))
        )
        .withColumnsRenamed({"product_id": "external_product_id", "sku_id": "external_sku_id"})
        .drop("s0", "k0", "entries")
    )
    return rules.device_identity(rows).select("p_partkey", "identity_code", "identity_status")


_PROFILES = {
    "FRESH_APPLE": ("fresh-apple", "WEIGHT"),
    "FRESH_EGG": ("packaged-egg", "COUNT"),
    "FRESH_PORK": ("fresh-pork", "WEIGHT"),
    "FRESH_MONITORED_COMMODITY": ("government-fresh", "WEIGHT"),
}
_SHARED = ["origin", "grade", "freshness_state", "packaging"]
_RULE_FIELDS = {
    "FRESH_APPLE": (["variety", *_SHARED], ["fruit_diameter_mm"]),
    "FRESH_EGG": (["egg_type", *_SHARED], ["shell_color"]),
    "FRESH_PORK": (["cut", *_SHARED], ["bone_state", "skin_state"]),
    "FRESH_MONITORED_COMMODITY": (
        ["commodity_code", "commodity_name", "commodity_group", "source_specification", "quoted_unit"],
        [],
    ),
}


def _sql_value(name: str) -> str:
    raw = f"nullif({sql_strip(name)}, '')"
    if name in vocab.ALIASES:
        return sql_map(vocab.ALIASES[name], f"upper({sql_compact(name)})")
    if name == "origin":
        return f"CASE WHEN regexp_full_match({sql_compact(name)}, '[\\x00-\\x7f]*') THEN upper({sql_compact(name)}) ELSE {sql_compact(name)} END"
    if name == "quoted_unit":
        return sql_map(vocab.QUOTED_UNITS, f"lower({sql_compact(name)})")
    if name == "fruit_diameter_mm":
        return f"CASE WHEN TRY_CAST({raw} AS DECIMAL(18,4)) > 0 THEN {sql_token(f'TRY_CAST({raw} AS DECIMAL(18,4))')} END"
    if name in ("commodity_name", "source_specification"):
        return sql_squeeze(name)
    token = f"upper(regexp_replace({raw}, '{WS}+', '_', 'g'))"
    if name == "commodity_code":
        return f"CASE WHEN regexp_full_match({token}, '[A-Z][A-Z0-9_]{{1,63}}') THEN {token} END"
    return token


_NAMES = sorted({n for r, o in _RULE_FIELDS.values() for n in (*r, *o)})
_IDENTITY_SQL = (
    "i1 AS (SELECT *, CASE category_code "
    + " ".join(f"WHEN '{k}' THEN '{m}'" for k, (_, m) in _PROFILES.items())
    + " END AS measure, "
    + ", ".join(
        f"CASE WHEN nullif({sql_strip(n)}, '') IS NOT NULL THEN {_sql_value(n)} END AS v_{n},"
        f" nullif({sql_strip(n)}, '') IS NOT NULL AS p_{n}"
        for n in _NAMES
    )
    + " FROM fresh_rows WHERE category_code LIKE 'FRESH%' AND category_code != 'FRESH_FOOD'),"
    + sql_quantity("i1", f"nullif({sql_strip('net_content')}, '')", "measure")
    + ", i2 AS (SELECT *, CASE category_code "
    + " ".join(
        f"WHEN '{k}' THEN [{', '.join(f'p_{n} AND v_{n} IS NULL' for n in (*r, *o))}]"
        for k, (r, o) in _RULE_FIELDS.items()
    )
    + " END AS bad, CASE category_code "
    + " ".join(
        f"WHEN '{k}' THEN NOT ({' AND '.join(f'p_{n}' for n in r)})"
        for k, (r, _) in _RULE_FIELDS.items()
    )
    + " END AS missing FROM q9),"
    + " i3 AS (SELECT *, CASE WHEN list_contains(bad, true) THEN 'IDENTITY_VALUE_UNSUPPORTED'"
    + " WHEN missing THEN 'IDENTITY_FIELDS_MISSING' WHEN q_error IS NOT NULL THEN 'QUANTITY_UNRESOLVED'"
    + " WHEN category_code = 'FRESH_MONITORED_COMMODITY' AND NOT coalesce(base_unit = 'KG' AND"
    + " base_quantity_value = CASE v_quoted_unit WHEN 'CNY_PER_500G' THEN 0.5 ELSE 1 END, false)"
    + " THEN 'QUOTED_UNIT_MISMATCH' END AS identity_code FROM i2),"
    # Attributes read before the first unsupported value stay; later ones are dropped.
    + " i4 AS (SELECT *, coalesce(list_position(bad, true), 99) AS stop FROM i3),"
    + " i5 AS (SELECT *, '{' || array_to_string(list_filter(CASE category_code "
    + " ".join(
        f"WHEN '{k}' THEN ["
        + ", ".join(
            ("'\"animal_type\":\"PORK\"'" if n == "animal_type" else
             f"CASE WHEN {([*r, *o].index(n)) + 1} < stop AND v_{n} IS NOT NULL THEN '\"{n}\":\"' || v_{n} || '\"' END")
            for n in sorted([*r, *o, *(["animal_type"] if k == "FRESH_PORK" else [])])
        )
        + "]"
        for k, (r, o) in _RULE_FIELDS.items()
    )
    + " END, lambda x: x IS NOT NULL), ',') || '}' AS attributes_json FROM i4)"
)


def _fresh_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = bind.ATTRIBUTE_NAMES
    pairs = [x for n in names for x in (F.lit(n), c(n))]
    rows = spread(bind.settled(bind.frame(spark, sf_dir, "fresh_rows")))
    return rows.select("p_partkey", "category_code", F.create_map(*pairs).alias("source_attributes"))


def fresh_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = rules.dispatch(_fresh_frame(spark, sf_dir)).where(
        c("dispatch_error").isNull() & (c("profile") != rules.DEVICE_PROFILE)
    )
    return rules.fresh_identity(routed, c("profile"))


@query(
    "fresh_identity_rules",
    "RUL-04 RUL-05 RUL-06 RUL-07 RUL-08",
    ctes("fresh_rows", extra=_IDENTITY_SQL)
    + """SELECT p_partkey, category_code, identity_code, CASE WHEN identity_code IS NULL THEN 'ACCEPTED'
           ELSE 'REVIEW_REQUIRED' END AS identity_status, attributes_json, quantity_unit,
           base_quantity_value, base_quantity_min, base_unit, package_count FROM i5""",
)
def fresh_identity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_identities(spark, sf_dir).select(
        "p_partkey", "category_code", "identity_code", "identity_status",
        identity.canonical_json(c("normalized_attributes")).alias("attributes_json"),
        "quantity_unit", "base_quantity_value", "base_quantity_min", "base_unit", "package_count",
    )


def _js(name: str) -> str:
    return f"coalesce('\"' || {name} || '\"', 'null')"


@query(
    "listing_fingerprints",
    "FN-31",
    ctes("fresh_rows", extra=_IDENTITY_SQL)
    + f"""SELECT p_partkey, sha256('{{"base_quantity_max":' || {_js(sql_token('base_quantity_max'))}
           || ',"base_quantity_min":' || {_js(sql_token('base_quantity_min'))}
           || ',"base_quantity_value":' || {_js(sql_token('base_quantity_value'))}
           || ',"base_unit":' || {_js('base_unit')} || ',"condition_code":"NEW","measure_type":"' || measure
           || '","normalized_attributes":' || attributes_json || ',"package_count":'
           || coalesce(CAST(package_count AS VARCHAR), 'null')
           || ',"quantity_max":null,"quantity_min":null,"quantity_unit":null,"quantity_value":null}}')
           AS identity_fingerprint FROM i5""",
)
def listing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_fingerprint(fresh_identities(spark, sf_dir)).select(
        "p_partkey", "identity_fingerprint"
    )


@query(
    "rule_dispatch",
    "RUL-10 UDF-01 SRC-13",
    ctes("fresh_rows")
    + "SELECT p_partkey, category_code, CASE category_code WHEN 'FRESH_FOOD' THEN 'CATEGORY_NOT_ENABLED_LEAF'"
    " WHEN 'NO_SUCH_CATEGORY' THEN 'CATEGORY_UNKNOWN' END AS dispatch_error, CASE category_code "
    + " ".join(f"WHEN '{k}' THEN '{p}@1'" for k, (p, _) in _PROFILES.items())
    + " WHEN 'PHONE' THEN 'electronic-device@1' END AS normalizer_version FROM fresh_rows",
)
def rule_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.dispatch(_fresh_frame(spark, sf_dir)).select(
        "p_partkey", "category_code", "dispatch_error", "normalizer_version"
    )


@query(
    "price_candidates",
    "FN-42",
    ctes(
        "money_texts",
        extra="""s AS (SELECT *, CASE WHEN l_partkey % 5 > 0 THEN text END AS shown,
            CASE l_linenumber % 4 WHEN 0 THEN 'ON_SALE' WHEN 1 THEN 'OFF_SHELF' WHEN 2 THEN 'COMING_SOON'
              ELSE 'UNKNOWN' END AS availability FROM money_texts),"""
        + sql_amount("s", "shown", "'当前售价'", "a")
        + ","
        + sql_amount("a2", "original_text", "'划线原价'", "b")
        + """,
        t AS (SELECT *, CASE WHEN a_status = 'OK' THEN a_l[1] END AS cur,
                CASE WHEN b_status = 'OK' THEN b_l[1] END AS orig FROM b2)""",
    )
    + f"""SELECT l_orderkey, l_linenumber, shown, original_text, availability, cur AS current_price,
            CASE WHEN shown IS NOT NULL AND cur IS DISTINCT FROM orig THEN orig END AS original_price,
            CASE WHEN shown IS NULL OR original_text IS NULL OR cur IS NOT DISTINCT FROM orig THEN 'NONE'
                 ELSE {sql_otype('original_text', "'划线原价'")} END AS original_price_type,
            CASE WHEN shown IS NOT NULL THEN 'DIRECT_UNCONDITIONAL'
                 WHEN availability IN ('OFF_SHELF', 'COMING_SOON') THEN 'AVAILABILITY_ONLY' END AS price_type,
            CASE WHEN shown IS NOT NULL THEN 'PACKAGE_TOTAL'
                 WHEN availability IN ('OFF_SHELF', 'COMING_SOON') THEN 'UNKNOWN' END AS pricing_basis,
            CASE WHEN shown IS NOT NULL THEN 'ITEM_ONLY'
                 WHEN availability IN ('OFF_SHELF', 'COMING_SOON') THEN 'NOT_APPLICABLE' END AS fee_status,
            CASE WHEN shown IS NOT NULL THEN CASE WHEN b_status != 'OK' THEN b_status
                    WHEN a_status != 'OK' THEN a_status END
                 WHEN availability NOT IN ('OFF_SHELF', 'COMING_SOON') THEN 'PRICE_UNSTATED' END AS error
          FROM t""",
)
def price_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.when(c("l_partkey") % 5 > 0, c("text"))
    state = F.expr(pick("l_linenumber", ["ON_SALE", "OFF_SHELF", "COMING_SOON", "UNKNOWN"]))
    rows = spread(bind.frame(spark, sf_dir, "money_texts")).withColumns({"shown": shown, "state": state})
    return (
        device.with_price_candidate(
            rows, "p", c("shown"), c("original_text"), F.lit("划线原价"), F.lit("当前售价"),
            c("state"),
        )
        .select("l_orderkey", "l_linenumber", "shown", "original_text", "p.*")
        .drop("displayed_price_text")
    )


@query(
    "dimension_mapping",
    "FN-43 FN-44",
    ctes("device_rows")
    + """SELECT p_partkey, coalesce(nullif(capacity, ''), memory) AS capacity, color AS color,
           CASE WHEN extra_value != '' THEN 'chip=' || extra_value END AS rest,
           array_to_string(list_filter([p_name, nullif(color, ''), CASE WHEN color IS DISTINCT FROM nullif(capacity, '')
             THEN nullif(capacity, '') END, sku_id], lambda x: x IS NOT NULL), ' ') AS title FROM device_rows""",
)
def dimension_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = F.create_map(
        F.lit("capacity"), c("capacity"), F.lit("storage"), c("memory"), F.lit("color"), c("color"),
        F.lit("chip"), c("extra_value"), F.lit("blank"), F.lit(""),
    )
    df = bind.settled(bind.frame(spark, sf_dir, "device_rows")).withColumn("dims", dims)
    fields, rest = device.map_dimensions("APPLE", c("dims"))
    return df.select(
        "p_partkey", fields["capacity"].alias("capacity"), fields["color"].alias("color"),
        F.array_join(
            F.transform(F.map_entries(rest), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
        ).alias("rest"),
        device.display_title(c("p_name"), c("color"), c("capacity"), c("p_name"), c("sku_id")).alias("title"),
    )
