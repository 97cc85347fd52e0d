"""Join patterns, set differences, ordered reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes, pick
from pricestrata.functions import vocab
from pricestrata.operators import facts as fact_ops
from pricestrata.operators import lookups as ops
from pricestrata.operators.ordered import newest
from pricestrata.operators.quality import advertised_fault
from pricestrata.queries import query

c = F.col


@query(
    "record_run_channel",
    "JON-01",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, c_mktsegment FROM lineitem
       JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
)
def record_run_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows with their run and channel: the same keys as record, run and channel."""
    records = bind.frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    runs = bind.frame(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    channels = bind.frame(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = ops.record_chain(
        records, runs, channels, c("l_orderkey") == c("o_orderkey"), c("o_custkey") == c("c_custkey")
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "c_mktsegment")


@query(
    "star_with_optional_brand",
    "JON-02",
    """SELECT r_name, p_type, quality IS NOT NULL AS has_label, count(*) AS rows,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS amount
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
       JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
       JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
       LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY 1) ON doc_id = l_partkey
       GROUP BY ALL""",
)
def star_with_optional_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: bind.frame(spark, sf_dir, n) for n in (
        "lineitem", "orders", "customer", "nation", "region", "part", "supplier", "labels")}
    optional = t["labels"].groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = ops.star(
        t["lineitem"],
        [
            (t["orders"], c("o_orderkey") == c("l_orderkey")),
            (t["customer"], c("c_custkey") == c("o_custkey")),
            (t["nation"], c("n_nationkey") == c("c_nationkey")),
            (t["region"], c("r_regionkey") == c("n_regionkey")),
            (t["part"], c("p_partkey") == c("l_partkey")),
            (t["supplier"], c("s_suppkey") == c("l_suppkey")),
        ],
        [(optional, c("doc_id") == c("l_partkey"))],
    )
    return (
        joined.groupBy("r_name", "p_type", c("quality").isNotNull().alias("has_label"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(c("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("amount"),
        )
    )


@query(
    "as_of_prices",
    "JON-04",
    ctes("points")
    + """, t AS (SELECT o_orderkey, 'L' || CAST(o_custkey AS VARCHAR) AS listing_id,
             TIMESTAMP '2024-01-01' + to_hours(CAST(o_orderkey % 720 AS INTEGER)) AS target_at FROM orders),
         f AS (SELECT listing_id, observed_at, current_price FROM points
               WHERE quality_status = 'ACCEPTED' AND current_price IS NOT NULL),
         j AS (SELECT o_orderkey, t.listing_id, target_at, observed_at, current_price
               FROM t ASOF LEFT JOIN f ON t.listing_id = f.listing_id AND t.target_at >= f.observed_at)
         SELECT o_orderkey, listing_id, target_at,
           CASE WHEN observed_at >= target_at - INTERVAL 36 HOUR THEN observed_at END AS fact_time,
           CASE WHEN observed_at >= target_at - INTERVAL 36 HOUR THEN current_price END AS fact FROM j""",
)
def as_of_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    targets = bind.frame(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("L"), c("o_custkey").cast("string")).alias("listing_id"),
        (start + F.make_dt_interval(F.lit(0), (c("o_orderkey") % 720).cast("int"))).alias("target_at"),
    )
    facts = bind.frame(spark, sf_dir, "points").where(
        "quality_status = 'ACCEPTED' AND current_price IS NOT NULL"
    )
    return ops.as_of(
        targets, facts, ["listing_id"], "target_at", "observed_at", c("current_price"),
        max_age="36 HOURS",
    )


@query(
    "listing_trajectory",
    "JON-05",
    ctes("publications")
    + """, firsts AS (SELECT * FROM publications QUALIFY row_number() OVER (
             PARTITION BY listing_id, revision_id, observed_at, source_hash, payload_hash ORDER BY ingest_seq) = 1)
         SELECT listing_id, observed_at, ingest_seq, current_price FROM firsts
         QUALIFY row_number() OVER (PARTITION BY listing_id, revision_id, observed_at ORDER BY ingest_seq DESC) = 1""",
)
def listing_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = fact_ops.correction_chain(bind.frame(spark, sf_dir, "publications"))
    return ops.trajectory(chain, c("region_code") == "ALL").select(
        "listing_id", "observed_at", "ingest_seq", "current_price"
    )


@query(
    "latest_with_record",
    "JON-06",
    ctes("points")
    + """, r AS (SELECT record_id, CASE WHEN k % 3 = 0 THEN 'other' ELSE product_id END AS entity_key FROM points),
         t AS (SELECT * FROM points WHERE quality_status = 'ACCEPTED' QUALIFY row_number() OVER (
               PARTITION BY listing_id ORDER BY observed_at DESC, ingest_seq DESC) = 1)
         SELECT listing_id, product_id, record_id, observed_at FROM t JOIN r USING (record_id)
         WHERE entity_key = product_id""",
)
def latest_with_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bind.frame(spark, sf_dir, "points")
    records = points.select(
        "record_id", F.when(c("k") % 3 == 0, "other").otherwise(c("product_id")).alias("entity_key")
    )
    return ops.latest_with_record(points, records).select(
        "listing_id", "product_id", "record_id", "observed_at"
    )


@query(
    "overlapping_intervals",
    "JON-07",
    """WITH i AS (SELECT l_partkey, row_number() OVER () AS id, CAST(l_shipdate AS DATE) AS s,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity - 1 AS INTEGER) END AS e
          FROM lineitem),
        p AS (SELECT a.l_partkey, count(*) AS pairs FROM i a JOIN i b ON a.l_partkey = b.l_partkey AND a.id < b.id
          AND a.s < coalesce(b.e, DATE '9999-12-31') AND b.s < coalesce(a.e, DATE '9999-12-31') GROUP BY 1)
       SELECT l_partkey, count(*) AS intervals, any_value(coalesce(pairs, 0)) AS overlapping_pairs
       FROM i LEFT JOIN p USING (l_partkey) GROUP BY 1""",
)
def overlapping_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = c("l_shipdate").cast("date")
    rows = bind.frame(spark, sf_dir, "lineitem").select(
        "l_partkey",
        start.alias("s"),
        F.when(c("l_linenumber") != 7, F.date_add(start, (c("l_quantity") - 1).cast("int"))).alias("e"),
    )
    far = F.lit("9999-12-31").cast("date")
    counted = ops.overlap_counts(rows, ["l_partkey"], "s", "e", F.year("__at"), far)
    return counted.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("intervals"), F.sum("overlaps").alias("overlapping_pairs")
    )


@query(
    "undiscovered_products",
    "JON-08",
    ctes("points", "sightings")
    + """SELECT DISTINCT channel, product_id FROM points p WHERE NOT EXISTS (
           SELECT 1 FROM sightings s WHERE s.channel = p.channel AND s.product_id = p.product_id
             AND s.run_at = (SELECT max(run_at) FROM sightings x WHERE x.channel = s.channel))""",
)
def undiscovered_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = bind.frame(spark, sf_dir, "points").select("channel", "product_id").distinct()
    sightings = bind.frame(spark, sf_dir, "sightings")
    last = sightings.groupBy("channel").agg(F.max("run_at").alias("run_at"))
    found = sightings.join(last, ["channel", "run_at"], "left_semi")
    return ops.not_discovered(known, found, ["channel", "product_id"])


@query(
    "outdated_points",
    "JON-09",
    ctes("points")
    + """SELECT ingest_seq FROM points p WHERE EXISTS (SELECT 1 FROM points q WHERE q.listing_id = p.listing_id
           AND q.region_scope = p.region_scope AND q.region_code = p.region_code
           AND q.quality_status = 'ACCEPTED' AND q.observed_at > p.observed_at)""",
)
def outdated_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["listing_id", "region_scope", "region_code"]
    return ops.superseded_by_newer(bind.frame(spark, sf_dir, "points"), keys, "observed_at").select(
        "ingest_seq"
    )


@query(
    "null_safe_compare",
    "JON-10",
    ctes("points")
    + """SELECT rejection_code, original_price, count(*) AS rows FROM (
           SELECT p.rejection_code, p.original_price FROM points p WHERE EXISTS (SELECT 1 FROM (
             SELECT DISTINCT rejection_code, original_price FROM points WHERE quality_status != 'ACCEPTED') d
             WHERE d.rejection_code IS NOT DISTINCT FROM p.rejection_code
               AND d.original_price IS NOT DISTINCT FROM p.original_price)) GROUP BY ALL""",
)
def null_safe_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bind.frame(spark, sf_dir, "points")
    left = points.groupBy("rejection_code", "original_price").agg(F.count(F.lit(1)).alias("rows"))
    right = points.where("quality_status != 'ACCEPTED'")
    return ops.same_values(left, right, ["rejection_code", "original_price"])


_NAMES = [r[2] for r in vocab.CITY_COMMODITIES]
_SPECS = [r[3] for r in vocab.CITY_COMMODITIES]
_GROUPS = [r[1] for r in vocab.CITY_COMMODITIES]
bind.VIEWS["sheet_columns"] = (
    "SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_linenumber, "
    + pick("l_partkey", _GROUPS)
    + " AS commodity_group, "
    + pick("l_partkey", [*_NAMES])
    + " AS commodity_name, "
    + pick("(l_partkey + CASE WHEN l_suppkey % 9 = 0 THEN 1 ELSE 0 END)", _SPECS)
    + " AS specification, '元/500克' AS unit, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM {lineitem}"
)


@query(
    "whitelist_columns",
    "JON-11",
    ctes("sheet_columns")
    + ", w AS (SELECT * FROM (VALUES "
    + ", ".join(str(r) for r in vocab.CITY_COMMODITIES)
    + """) AS t(commodity_code, commodity_group, commodity_name, specification, unit))
       SELECT d.day, w.commodity_code, count(s.day) AS matches, min(s.price) AS price,
         CASE WHEN count(s.day) != 1 THEN 'COMMODITY_MAPPING_MISSING' END AS error_code
       FROM (SELECT DISTINCT day FROM sheet_columns) d CROSS JOIN w LEFT JOIN sheet_columns s
         ON s.day = d.day AND s.commodity_group = w.commodity_group AND s.commodity_name = w.commodity_name
         AND s.specification = w.specification AND s.unit = w.unit GROUP BY 1, 2""",
)
def whitelist_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ["commodity_group", "commodity_name", "specification", "unit"]
    return ops.whitelist(
        bind.frame(spark, sf_dir, "sheet_columns"), vocab.CITY_COMMODITIES, dims, ["day"]
    ).drop("entry_no")


@query(
    "coverage_gap",
    "SET-01",
    ctes("points")
    + """SELECT product_id, listing_id FROM points WHERE quality_status = 'ACCEPTED'
         EXCEPT SELECT product_id, listing_id FROM points WHERE observed_date >= DATE '2024-01-29' AND availability = 'ON_SALE'""",
)
def coverage_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bind.frame(spark, sf_dir, "points")
    captured = points.where("observed_date >= DATE '2024-01-29' AND availability = 'ON_SALE'")
    return ops.coverage_gap(
        points.where("quality_status = 'ACCEPTED'"), captured, ["product_id", "listing_id"]
    )


@query(
    "sku_set_compare",
    "SET-02",
    """WITH s AS (SELECT l_orderkey, list_distinct(list(l_linenumber)) AS seen FROM lineitem GROUP BY 1),
         a AS (SELECT *, list_distinct(list_concat(list_filter(seen, lambda x: x > 1), [l_orderkey % 8])) AS advertised FROM s)
       SELECT l_orderkey, len(list_filter(advertised, lambda x: NOT list_contains(seen, x))) AS omitted,
         len(list_filter(seen, lambda x: NOT list_contains(advertised, x))) AS unadvertised,
         CASE WHEN len(advertised) > 5 THEN 'SKU_LIMIT_EXCEEDED' END AS error_code FROM a""",
)
def sku_set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertised against returned SKUs of one order; line numbers bound the arrays."""
    seen = bind.frame(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_set("l_linenumber").alias("seen")
    )
    advertised = F.array_union(
        F.filter("seen", lambda x: x > 1), F.array((c("l_orderkey") % 8).cast("int"))
    )
    rows = seen.withColumn("advertised", advertised)
    return rows.select(
        "l_orderkey",
        F.size(F.array_except("advertised", "seen")).cast("bigint").alias("omitted"),
        F.size(F.array_except("seen", "advertised")).cast("bigint").alias("unadvertised"),
        advertised_fault(c("advertised"), 5).alias("error_code"),
    )


@query(
    "row_union",
    "SET-03",
    """SELECT kind, count(*) AS rows, count(sku_id) AS with_sku, count(dataset_key) AS with_dataset,
         CAST(sum(price) AS DECIMAL(38,2)) AS amount FROM (
         SELECT 'product' AS kind, CAST(l_partkey AS VARCHAR) AS sku_id, NULL AS dataset_key,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem
         UNION ALL SELECT 'document', NULL, event_type, CAST(value AS DECIMAL(18,2)) FROM events) GROUP BY 1""",
)
def row_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = bind.frame(spark, sf_dir, "lineitem").select(
        c("l_partkey").cast("string").alias("sku_id"),
        c("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    documents = bind.frame(spark, sf_dir, "events").select(
        c("event_type").alias("dataset_key"),
        c("value").cast("decimal(18,2)").alias("price"),
    )
    return (
        ops.one_shape(products, documents)
        .groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count("sku_id").alias("with_sku"),
            F.count("dataset_key").alias("with_dataset"),
            F.sum("price").cast("decimal(38,2)").alias("amount"),
        )
    )


@query(
    "price_samples",
    "ORD-01",
    ctes("points")
    + """SELECT listing_id, region_code, ingest_seq, current_price, (SELECT count(*) FROM points) > 10 AS truncated
         FROM points ORDER BY observed_at, ingest_seq LIMIT 10""",
)
def price_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.first_samples(
        bind.frame(spark, sf_dir, "points"), [c("observed_at"), c("ingest_seq")], 10
    ).select("listing_id", "region_code", "ingest_seq", "current_price", "truncated")


@query(
    "capped_products",
    "ORD-02",
    ctes("points")
    + """SELECT channel, observed_date AS run_at, product_id, first_seq, row_number() OVER w AS place,
           row_number() OVER w > 5 AS beyond_cap
         FROM (SELECT channel, observed_date, product_id, min(ingest_seq) AS first_seq FROM points
               GROUP BY ALL) WINDOW w AS (PARTITION BY channel, observed_date ORDER BY first_seq)""",
)
def capped_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of a run in the order in which they were found; five are taken, all are kept."""
    found = (
        bind.frame(spark, sf_dir, "points")
        .groupBy("channel", c("observed_date").alias("run_at"), "product_id")
        .agg(F.min("ingest_seq").alias("first_seq"))
    )
    return ops.capped(found, ["channel", "run_at"], ["first_seq"], 5, F.floor(c("first_seq") / 1000)).select(
        "channel", "run_at", "product_id", "first_seq", c("place").cast("bigint").alias("place"), "beyond_cap"
    )


@query(
    "numeric_order",
    "ORD-03",
    """SELECT CAST(s_suppkey AS VARCHAR) AS market_id, s_name FROM supplier ORDER BY s_suppkey""",
)
def numeric_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ids in numeric order."""
    return (
        bind.frame(spark, sf_dir, "supplier")
        .select(c("s_suppkey").cast("string").alias("market_id"), "s_name")
        .orderBy(c("market_id").cast("bigint"))
    )


@query(
    "facts_of_records",
    "ORD-04",
    ctes("points")
    + """SELECT product_id, observed_date, ingest_seq, quality_status FROM points
         ORDER BY product_id, observed_date, ingest_seq""",
)
def facts_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "points").select(
        "product_id", "observed_date", "ingest_seq", "quality_status"
    )
    return ops.facts_of_records(rows, ["product_id", "observed_date"], ["ingest_seq"])


@query(
    "newest_per_listing",
    "WIN-01 ORD-02",
    ctes("points")
    + """SELECT listing_id, ingest_seq, observed_at FROM points
         QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY observed_at DESC, ingest_seq DESC) = 1""",
)
def newest_per_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(
        bind.frame(spark, sf_dir, "points").select("listing_id", "ingest_seq", "observed_at"),
        ["listing_id"],
        [c("observed_at"), c("ingest_seq")],
    )
