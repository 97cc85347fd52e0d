"""Quality counts, run totals, duplicates, coverage and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.operators import quality as ops
from pricestrata.queries import query

c = F.col
UNIT = ["product_id", "capture_day"]


def sql_signature(text: str) -> str:
    lanes = ", ".join(
        f"CAST(sum(CAST(('0x' || substr(sha256({text}), {start}, 15)) AS HUGEINT)) AS VARCHAR) AS signature_{name}"
        for name, start in (("a", 1), ("b", 16))
    )
    return f"count({text}) AS signature_rows, {lanes}"


_UNITS = """
cell AS (SELECT product_id, capture_day, listing_id, region_scope, region_code,
    min(identity_status) AS ids, bool_or(quality_status = 'ACCEPTED') AS ok,
    count(*) FILTER (quality_status = 'ACCEPTED') AS acc,
    count(*) FILTER (quality_status = 'REVIEW_REQUIRED') AS rev,
    count(*) FILTER (quality_status = 'REJECTED') AS rej FROM captured GROUP BY ALL),
rows_ AS (SELECT product_id, capture_day, listing_id, min(ids) AS ids, bool_and(ok) AS cov,
    sum(acc) AS acc, sum(rev) AS rev, sum(rej) AS rej FROM cell GROUP BY ALL),
units AS (SELECT product_id, capture_day, count(*) AS row_count,
    CAST(sum(CASE WHEN ids = 'ACCEPTED' THEN acc ELSE 0 END) AS BIGINT) AS accepted_count,
    CAST(sum(CASE ids WHEN 'ACCEPTED' THEN rev WHEN 'REVIEW_REQUIRED' THEN 1 ELSE 0 END) AS BIGINT) AS review_count,
    CAST(sum(CASE ids WHEN 'ACCEPTED' THEN rej WHEN 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) AS rejected_count,
    bool_and(ids = 'ACCEPTED' AND cov) AS complete FROM rows_ GROUP BY ALL),
errs AS (SELECT product_id, capture_day, first(code ORDER BY listing_id, pos) AS code FROM (
    SELECT product_id, capture_day, listing_id, -1 AS pos, identity_code AS code FROM captured
    UNION ALL SELECT product_id, capture_day, listing_id, ingest_seq, rejection_code FROM captured)
  WHERE code IS NOT NULL GROUP BY ALL),
stated AS (SELECT u.*, CASE WHEN accepted_count = 0 THEN 'FAILED' WHEN complete THEN 'SUCCEEDED' ELSE 'PARTIAL' END
    AS status, CASE WHEN NOT complete THEN coalesce(e.code, 'NO_ACCEPTED_PRICE') END AS error_code
  FROM units u LEFT JOIN errs e USING (product_id, capture_day))"""


@query("unit_quality", "AGG-01 AGG-02", ctes("captured", extra=_UNITS) + "SELECT * FROM units")
def unit_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unit_quality(bind.frame(spark, sf_dir, "captured"), UNIT, "listing_id")


@query("unit_status", "AGG-03", ctes("captured", extra=_UNITS) + "SELECT * FROM stated")
def unit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.unit_status(bind.frame(spark, sf_dir, "captured"), UNIT, "listing_id", "ingest_seq")


_RUNS = _UNITS + """,
coded AS (SELECT capture_day, error_code, count(*) AS n FROM stated WHERE error_code IS NOT NULL GROUP BY ALL),
hist AS (SELECT capture_day, string_agg(error_code || '=' || n, ',' ORDER BY error_code) AS errors FROM coded GROUP BY 1),
runs_ AS (SELECT capture_day, count(*) AS discovered_count, CAST(sum(accepted_count) AS BIGINT) AS accepted_count,
    CAST(sum(review_count) AS BIGINT) AS review_count, CAST(sum(rejected_count) AS BIGINT) AS rejected_count
  FROM stated GROUP BY 1),
totals AS (SELECT r.*, coalesce(errors, '') AS errors, CASE WHEN accepted_count = 0 THEN 'FAILED'
    WHEN errors IS NOT NULL THEN 'PARTIAL' ELSE 'SUCCEEDED' END AS status FROM runs_ r LEFT JOIN hist USING (capture_day))"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = ops.unit_status(bind.frame(spark, sf_dir, "captured"), UNIT, "listing_id", "ingest_seq")
    return ops.run_totals(units, ["capture_day"])


@query("run_totals", "AGG-04", ctes("captured", extra=_RUNS) + "SELECT * FROM totals")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.array_join(
        F.transform(F.map_entries("error_summary"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    )
    return _runs(spark, sf_dir).withColumn("errors", text).drop("error_summary")


@query(
    "combined_status",
    "AGG-05",
    """WITH r AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'PARTIAL'
          ELSE 'FAILED' END AS status, o_orderkey % 3 AS accepted_count FROM orders)
       SELECT o_custkey, count(*) AS runs, CASE WHEN bool_and(status = 'SUCCEEDED') THEN 'SUCCEEDED'
         WHEN bool_or(accepted_count != 0) THEN 'PARTIAL' ELSE 'FAILED' END AS status FROM r GROUP BY 1""",
)
def combined_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(c("o_orderstatus") == "F", "SUCCEEDED")
        .when(c("o_orderstatus") == "O", "PARTIAL")
        .otherwise("FAILED")
    )
    runs = bind.frame(spark, sf_dir, "orders").select(
        "o_custkey", status.alias("status"), (c("o_orderkey") % 3).alias("accepted_count")
    )
    return ops.combined_status(runs, ["o_custkey"])


@query(
    "duplicate_identities",
    "AGG-06",
    """SELECT l_orderkey, CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (n > 1) AS repeated_keys,
         count(*) FILTER (n > 1) > 0 AS flagged
       FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL) GROUP BY 1""",
)
def duplicate_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.duplicate_identities(
        bind.frame(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_linenumber"]
    )


@query(
    "discovery_floor",
    "AGG-07",
    ctes("points", "sightings")
    + """, k AS (SELECT channel, count(DISTINCT product_id) AS known_count FROM points GROUP BY 1),
         f AS (SELECT channel, run_at, count(*) AS found_count FROM sightings GROUP BY ALL)
         SELECT channel, run_at, found_count, known_count,
           greatest(1, CAST(ceil(known_count * 0.6) AS BIGINT)) AS floor_count,
           found_count < greatest(1, CAST(ceil(known_count * 0.6) AS BIGINT)) AS below_floor
         FROM f JOIN k USING (channel)""",
)
def discovery_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = bind.frame(spark, sf_dir, "points").select("channel", "product_id").distinct()
    found = bind.frame(spark, sf_dir, "sightings")
    return ops.discovery_floor(found, known, ["channel"], ["run_at"], "0.6")


@query(
    "known_products",
    "AGG-08",
    ctes("points")
    + f""", a AS (SELECT * FROM points WHERE quality_status = 'ACCEPTED'),
         n AS (SELECT product_id, arg_max(record_id, (observed_at, ingest_seq)) AS context,
                 max(observed_at) AS last_seen_at FROM a GROUP BY 1)
         SELECT product_id, signature_rows, signature_a, signature_b, last_seen_at, context FROM n
         JOIN (SELECT product_id, {sql_signature('listing_id')} FROM
               (SELECT DISTINCT product_id, listing_id FROM a) GROUP BY 1) USING (product_id)""",
)
def known_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.known_products(bind.frame(spark, sf_dir, "points"), c("record_id"))


@query(
    "latest_documents",
    "AGG-09",
    """WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS doc_date,
          'https://source.example/' || CAST(l_partkey % 7 AS VARCHAR) AS url FROM lineitem)
       SELECT l_suppkey, doc_date, count(DISTINCT url) AS addresses, min(url) AS url,
         CASE WHEN count(DISTINCT url) > 1 THEN 'DISCOVERY_AMBIGUOUS' END AS error_code
       FROM d WHERE doc_date = (SELECT max(doc_date) FROM d x WHERE x.l_suppkey = d.l_suppkey) GROUP BY 1, 2""",
)
def latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.frame(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        c("l_shipdate").cast("date").alias("doc_date"),
        F.concat(F.lit("https://source.example/"), (c("l_partkey") % 7).cast("string")).alias("url"),
    )
    return ops.latest_document(docs, ["l_suppkey"], "doc_date", "url")


@query(
    "market_groups",
    "AGG-11 ORD-03",
    """WITH r AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day, l_suppkey % 5 AS market_id,
          l_returnflag || l_linestatus AS region_code, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
          'market ' || CAST(l_suppkey % 5 + CASE WHEN l_suppkey % 40 = 39 THEN 100 ELSE 0 END AS VARCHAR) AS market_name
          FROM lineitem),
        bad AS (SELECT DISTINCT l_partkey, day FROM (SELECT l_partkey, day, market_id, region_code FROM r
                  GROUP BY ALL HAVING count(*) > 1)
                UNION SELECT l_partkey, day FROM (SELECT l_partkey, day, market_id FROM r GROUP BY ALL
                  HAVING count(DISTINCT market_name) > 1))
       SELECT l_partkey, day, market_id, count(*) AS row_count, min(market_name) AS market_name,
         string_agg(region_code || ':' || CAST(price AS VARCHAR), ',' ORDER BY region_code) AS prices
       FROM r WHERE (l_partkey, day) NOT IN (SELECT (l_partkey, day) FROM bad) GROUP BY ALL""",
)
def market_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = c("l_suppkey") % 5
    renamed = F.when(c("l_suppkey") % 40 == 39, 100).otherwise(0)
    rows = bind.frame(spark, sf_dir, "lineitem").select(
        "l_partkey",
        c("l_shipdate").cast("date").alias("day"),
        market.alias("market_id"),
        F.concat("l_returnflag", "l_linestatus").alias("region_code"),
        c("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.concat(F.lit("market "), (market + renamed).cast("string")).alias("market_name"),
    )
    text = F.array_join(
        F.transform("prices", lambda p: F.concat_ws(":", p["region_code"], p["price"].cast("string"))), ","
    )
    return ops.market_groups(rows, ["l_partkey", "day"]).withColumn("prices", text)


@query(
    "commodity_coverage",
    "AGG-12",
    """SELECT p_type, count(*) AS rows, min(CAST(l_extendedprice AS DECIMAL(18,2))) AS min_price,
         max(CAST(l_extendedprice AS DECIMAL(18,2))) AS max_price
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def commodity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = bind.frame(spark, sf_dir, "lineitem").select(
        c("l_partkey").alias("p_partkey"), c("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    kinds = bind.frame(spark, sf_dir, "part").select("p_partkey", "p_type")
    return ops.coverage(price.join(kinds, "p_partkey"), ["p_type"], "price")


@query(
    "source_report",
    "AGG-13",
    ctes("points")
    + """, cur AS (SELECT * FROM points WHERE quality_status = 'ACCEPTED' QUALIFY row_number() OVER (
           PARTITION BY listing_id, region_scope, region_code ORDER BY observed_at DESC, ingest_seq DESC) = 1)
         SELECT channel, count(*) AS current_rows, count(original_price) AS with_original,
           count(*) FILTER (availability = 'ON_SALE') AS state_on_sale,
           count(*) FILTER (availability = 'OUT_OF_STOCK') AS state_out_of_stock,
           count(*) FILTER (availability = 'OFF_SHELF') AS state_off_shelf FROM cur GROUP BY 1""",
)
def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricestrata.operators.ordered import newest

    rows = bind.frame(spark, sf_dir, "points").where("quality_status = 'ACCEPTED'")
    current = newest(
        rows.select("channel", "listing_id", "region_scope", "region_code", "original_price",
                    "availability", "observed_at", "ingest_seq"),
        ["listing_id", "region_scope", "region_code"],
        [c("observed_at"), c("ingest_seq")],
    )
    return ops.source_report(current, ["ON_SALE", "OUT_OF_STOCK", "OFF_SHELF"])


_PRICE_TEXT = (
    "listing_id || '|' || region_code || '|' || coalesce(CAST(current_price AS VARCHAR), '')"
    " || '|' || availability"
)


def price_text() -> F.Column:
    return F.concat_ws(
        "|", "listing_id", "region_code",
        F.coalesce(c("current_price").cast("string"), F.lit("")), "availability",
    )


@query(
    "price_signatures",
    "AGG-14",
    ctes("captured")
    + f"""SELECT product_id, capture_day, {sql_signature('t')} FROM (SELECT *, {_PRICE_TEXT} AS t FROM captured
          WHERE quality_status = 'ACCEPTED') GROUP BY ALL""",
)
def price_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "captured").where("quality_status = 'ACCEPTED'")
    return ops.price_signatures(rows, UNIT, price_text())


@query(
    "merged_captures",
    "AGG-16",
    ctes("points")
    + """SELECT channel, region_code, observed_date, ingest_seq AS request_no, source_hash,
           count(*) OVER w AS responses, max(observed_at) OVER w AS fetched_at,
           CAST(sum(k) OVER w AS BIGINT) AS duration_ms FROM points
         WINDOW w AS (PARTITION BY channel, region_code, observed_date)""",
)
def merged_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "points").select(
        "channel", "region_code", "observed_date", "source_hash",
        c("ingest_seq").alias("request_no"), c("observed_at").alias("fetched_at"),
        c("k").alias("duration_ms"),
    )
    return ops.merge_captures(rows, ["channel", "region_code", "observed_date"])


@query(
    "product_distrust",
    "WIN-10",
    ctes("captured")
    + """SELECT ingest_seq, CASE WHEN bad AND quality_status = 'ACCEPTED' THEN 'REVIEW_REQUIRED' ELSE quality_status END
           AS quality_status, CASE WHEN bad AND quality_status = 'ACCEPTED' THEN 'PRODUCT_IDENTITY_UNTRUSTED'
           ELSE rejection_code END AS rejection_code
         FROM (SELECT *, bool_or(identity_status != 'ACCEPTED') OVER (PARTITION BY product_id, capture_day) AS bad
               FROM captured)""",
)
def product_distrust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.spread_distrust(bind.frame(spark, sf_dir, "captured"), UNIT).select(
        "ingest_seq", "quality_status", "rejection_code"
    )


@query(
    "listing_lifecycle",
    "WIN-11",
    ctes("captured")
    + """, g AS (SELECT listing_id, capture_day, bool_and(availability = 'OFF_SHELF') AS gone, max(observed_at) AS seen_at
           FROM captured WHERE quality_status = 'ACCEPTED' GROUP BY ALL)
         SELECT listing_id, max(seen_at) AS seen_at, CASE WHEN arg_max(gone, seen_at) THEN 'INACTIVE' ELSE 'ACTIVE' END
           AS lifecycle_status FROM g GROUP BY 1""",
)
def listing_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.lifecycle(bind.frame(spark, sf_dir, "captured"), ["capture_day"], "observed_at")
