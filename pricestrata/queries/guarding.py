"""Change and absence guards, dimension merges over events, parts and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.operators import guards as ops
from pricestrata.operators.merges import merge_dimension, upsert_by_time
from pricestrata.queries import query
from pricestrata.queries.captures import sql_signature

c = F.col

_PREVIOUS = """
priced AS (SELECT * FROM points WHERE quality_status = 'ACCEPTED' AND current_price IS NOT NULL),
changes AS (SELECT *, lag(current_price) OVER w AS previous_price, lag(observed_at) OVER w AS previous_at FROM priced
  WINDOW w AS (PARTITION BY listing_id, identity_fingerprint, region_scope, region_code
               ORDER BY observed_at, ingest_seq)),
flagged AS (SELECT *, coalesce(observed_at > previous_at
   AND abs(current_price - previous_price) > CAST(0.3 AS DECIMAL(6,4)) * previous_price, false) AS needs_confirmation
  FROM changes)"""


@query(
    "previous_prices",
    "WIN-02",
    ctes("points", extra=_PREVIOUS) + "SELECT ingest_seq, previous_price, previous_at FROM flagged",
)
def previous_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.previous_trusted(bind.frame(spark, sf_dir, "points")).select(
        "ingest_seq", c("previous.price").alias("previous_price"), c("previous.at").alias("previous_at")
    )


@query(
    "large_changes",
    "WIN-03",
    ctes("points", extra=_PREVIOUS)
    + "SELECT ingest_seq, listing_id, current_price, needs_confirmation FROM flagged",
)
def large_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.large_changes(bind.frame(spark, sf_dir, "points")).select(
        "ingest_seq", "listing_id", "current_price", "needs_confirmation"
    )


@query(
    "confirmed_changes",
    "MRG-07",
    ctes(
        "points",
        extra=_PREVIOUS
        + f""",
caps AS (SELECT p.product_id, CAST(EXTRACT(DAY FROM p.observed_date) AS BIGINT) AS capture_seq,
    max(p.observed_at) AS fetched_at, count(DISTINCT p.listing_id) <= 3 AS complete,
    coalesce(bool_or(f.needs_confirmation), false) AS needs_confirmation
  FROM points p LEFT JOIN flagged f USING (ingest_seq) GROUP BY 1, 2),
sigs AS (SELECT product_id, CAST(EXTRACT(DAY FROM observed_date) AS BIGINT) AS capture_seq, {sql_signature('availability')}
  FROM points WHERE quality_status = 'ACCEPTED' GROUP BY 1, 2),
two AS (SELECT *, lead(capture_seq) OVER w AS s2, lead(complete) OVER w AS c2, lead(fetched_at) OVER w AS f2,
    lead((signature_rows, signature_a, signature_b)) OVER w AS x2
  FROM caps LEFT JOIN sigs USING (product_id, capture_seq)
  WINDOW w AS (PARTITION BY product_id ORDER BY capture_seq)),
ver AS (SELECT *, CASE WHEN NOT needs_confirmation THEN 'TRUSTED'
    WHEN f2 > fetched_at AND complete AND c2 AND x2.signature_a IS NOT DISTINCT FROM signature_a
      AND x2.signature_rows IS NOT DISTINCT FROM signature_rows
      AND x2.signature_b IS NOT DISTINCT FROM signature_b THEN 'CONFIRMED'
    ELSE 'PRICE_CHANGE_UNCONFIRMED' END AS verdict FROM
  (SELECT * REPLACE (struct_pack(signature_rows := x2[1], signature_a := x2[2], signature_b := x2[3]) AS x2) FROM two))""",
    )
    + """SELECT product_id, capture_seq, needs_confirmation, verdict,
           CASE WHEN verdict = 'CONFIRMED' THEN s2 END AS confirmed_by FROM ver""",
)
def confirmed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = bind.frame(spark, sf_dir, "points").withColumn(
        "capture_seq", F.dayofmonth("observed_date").cast("bigint")
    )
    key = ["product_id", "capture_seq"]
    flagged = ops.large_changes(points).groupBy(*key).agg(
        F.bool_or("needs_confirmation").alias("needs_confirmation")
    )
    listings = points.groupBy(*key, "listing_id").agg(F.max("observed_at").alias("t"))
    captures = (
        listings.groupBy(*key)
        .agg(F.max("t").alias("fetched_at"), (F.count(F.lit(1)) <= 3).alias("complete"))
        .join(flagged, key, "left")
        .withColumn("needs_confirmation", F.coalesce("needs_confirmation", F.lit(False)))
    )
    rows = points.where("quality_status = 'ACCEPTED'")
    return ops.confirm_changes(captures, rows, c("availability")).select(
        *key, "needs_confirmation", "verdict", "confirmed_by"
    )


_STREAKS = """
nums AS (SELECT channel, run_at, row_number() OVER (PARTITION BY channel ORDER BY run_at) AS run_no FROM runs WHERE complete),
lasts AS (SELECT channel, max(run_no) AS last_no FROM nums GROUP BY 1),
seen AS (SELECT DISTINCT s.channel, product_id, s.run_at, run_no FROM sightings s
  JOIN nums n ON n.channel = s.channel AND n.run_at = s.run_at),
streaks AS (SELECT channel, product_id, run_at AS seen_at, CAST(run_no AS INT) AS run_no,
    CAST(coalesce(nxt - 1, last_no) - run_no AS INT) AS misses, nxt IS NULL AS open,
    coalesce(nxt - 1, last_no) - run_no >= 2 AS candidate
  FROM (SELECT *, lead(run_no) OVER (PARTITION BY channel, product_id ORDER BY run_no) AS nxt FROM seen)
  JOIN lasts USING (channel))"""


def _streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.miss_streaks(
        bind.frame(spark, sf_dir, "runs"), bind.frame(spark, sf_dir, "sightings"), 2
    )


@query("miss_streaks", "WIN-09", ctes("runs", "sightings", extra=_STREAKS) + "SELECT * FROM streaks")
def miss_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streaks(spark, sf_dir)


bind.VIEWS["probes"] = """
SELECT record_id, product_id, observed_at AS fetched_at, source_hash,
       CASE k % 4 WHEN 0 THEN 404 WHEN 1 THEN 410 ELSE 200 END AS http_status,
       'https://shop.example/' || product_id AS request_url,
       'https://shop.example/' || CASE WHEN k % 3 = 0 THEN 'home' ELSE product_id END AS final_url
FROM {points}
"""
_ABSENT = _STREAKS + """,
gone AS (SELECT * FROM probes WHERE http_status IN (404, 410) AND request_url = final_url),
absent AS (SELECT product_id, arg_min(record_id, (fetched_at, record_id)) AS record_id, min(fetched_at) AS fetched_at,
    arg_min(source_hash, (fetched_at, record_id)) AS source_hash
  FROM streaks JOIN gone USING (product_id) WHERE open AND candidate AND fetched_at > seen_at GROUP BY 1)"""


@query(
    "confirmed_absences",
    "MRG-08",
    ctes("runs", "sightings", "probes", extra=_ABSENT) + "SELECT * FROM absent",
)
def confirmed_absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.confirmed_absences(_streaks(spark, sf_dir), bind.frame(spark, sf_dir, "probes"))


@query(
    "absence_facts",
    "JON-12",
    ctes("runs", "sightings", "probes", "points", extra=_ABSENT)
    + """, l AS (SELECT product_id, listing_id, arg_max(revision_id, observed_at) AS revision_id FROM points
           WHERE quality_status = 'ACCEPTED' GROUP BY ALL)
         SELECT product_id, listing_id, revision_id, record_id, 'NATIONAL' AS region_scope, 'CN' AS region_code,
           'AVAILABILITY_ONLY' AS price_type, 'OFF_SHELF' AS availability, fetched_at AS observed_at, source_hash
         FROM absent JOIN l USING (product_id)""",
)
def absence_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    absent = ops.confirmed_absences(_streaks(spark, sf_dir), bind.frame(spark, sf_dir, "probes"))
    listings = (
        bind.frame(spark, sf_dir, "points")
        .where("quality_status = 'ACCEPTED'")
        .groupBy("product_id", "listing_id")
        .agg(F.max_by("revision_id", "observed_at").alias("revision_id"))
    )
    return ops.absence_facts(absent, listings).select(
        "product_id", "listing_id", "revision_id", "record_id", "region_scope", "region_code",
        "price_type", "availability", "observed_at", "source_hash",
    )


@query(
    "stale_runs",
    "MRG-06",
    """WITH r AS (SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'SUCCEEDED'
          ELSE 'PARTIAL' END AS status, o_custkey % 4 AS channel, o_orderkey % 3 AS scope_kind,
          o_custkey % 5 AS region FROM orders),
        s AS (SELECT *, status = 'RUNNING' AND channel < 2 AND scope_kind < 2 AND region < 3
            AND o_orderdate < TIMESTAMP '1998-06-01' - INTERVAL 90 MINUTE AS stale FROM r)
       SELECT o_orderkey, CASE WHEN stale THEN 'FAILED' ELSE status END AS status,
         CASE WHEN stale THEN 'STALE_RUNNING_RECOVERED' WHEN status = 'PARTIAL' THEN 'ROWS_REJECTED' END AS error_code,
         CASE WHEN stale THEN TIMESTAMP '1998-06-01' WHEN status != 'RUNNING' THEN o_orderdate END AS finished_at FROM s""",
)
def stale_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = (
        F.when(c("o_orderstatus") == "O", "RUNNING")
        .when(c("o_orderstatus") == "F", "SUCCEEDED")
        .otherwise("PARTIAL")
    )
    phone, tablet = F.lit("PHONE"), F.lit("TABLET")
    scope = (
        F.when(c("o_orderkey") % 3 == 0, F.array(phone, tablet))
        .when(c("o_orderkey") % 3 == 1, F.array(tablet, phone, phone))
        .otherwise(F.array(phone))
    )
    runs = bind.frame(spark, sf_dir, "orders").select(
        "o_orderkey", status.alias("status"), scope.alias("category_scope"),
        (c("o_custkey") % 4).alias("channel"), c("o_orderdate").alias("started_at"),
        F.when(status != "RUNNING", c("o_orderdate")).alias("finished_at"),
        F.when(status == "PARTIAL", "ROWS_REJECTED").alias("error_code"),
        F.when(c("o_custkey") % 5 < 4, "NATIONAL").otherwise("PROVINCE").alias("region_scope"),
        F.when(c("o_custkey") % 5 < 3, "CN").otherwise("SH").alias("region_code"),
    )
    now = F.lit("1998-06-01 00:00:00").cast("timestamp_ntz")
    return ops.recover_stale_runs(
        runs, now, 90, c("channel") < 2, ["TABLET", "PHONE"], ("NATIONAL", "CN")
    ).select("o_orderkey", "status", "error_code", "finished_at")


@query(
    "dimension_merge",
    "MRG-02",
    """WITH i AS (SELECT upper(p_brand) || '/' || p_name AS code, min(p_type) AS low, max(p_type) AS high FROM part
          WHERE p_size <= 40 GROUP BY 1),
        e AS (SELECT upper(p_brand) || '/' || p_name AS code, min(p_type) AS stored FROM part WHERE p_size > 15 GROUP BY 1)
       SELECT coalesce(i.code, e.code) AS code, coalesce(stored, low) AS p_type,
         CASE WHEN low IS NULL THEN 'KEPT' WHEN low != high THEN 'CONFLICT' WHEN stored IS NULL THEN 'NEW'
              WHEN stored = low THEN 'SAME' ELSE 'CONFLICT' END AS outcome
       FROM i FULL OUTER JOIN e ON i.code = e.code""",
)
def dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small and middle-sized parts arrive at a dimension built from middle-sized and large ones."""
    part = bind.frame(spark, sf_dir, "part").withColumn(
        "code", F.concat(F.upper("p_brand"), F.lit("/"), c("p_name"))
    )
    stored = part.where("p_size > 15").groupBy("code").agg(F.min("p_type").alias("p_type"))
    return merge_dimension(stored, part.where("p_size <= 40"), ["code"], ["p_type"])


@query(
    "merchant_upsert",
    "MRG-03",
    ctes("points")
    + """, a AS (SELECT listing_id, ingest_seq, availability, CASE WHEN k % 3 = 0 THEN record_id END AS external_id,
             quality_status = 'ACCEPTED' AS trusted, observed_at - to_days(CAST(k % 4 AS INTEGER)) AS t FROM points),
         b AS (SELECT *, min(ingest_seq) OVER (PARTITION BY listing_id) AS f FROM a),
         d AS (SELECT *, max(t) OVER (PARTITION BY listing_id ORDER BY ingest_seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM b WHERE trusted OR ingest_seq = f),
         e AS (SELECT *, seen IS NULL OR t > seen AS applied FROM d)
         SELECT listing_id, arg_max(availability, t) FILTER (applied) AS availability,
           arg_max(external_id, t) FILTER (applied AND external_id IS NOT NULL) AS external_id,
           min(t) AS first_seen_at, max(t) AS last_seen_at FROM e GROUP BY 1""",
)
def merchant_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "points").select(
        "listing_id", "ingest_seq", "availability",
        F.when(c("k") % 3 == 0, c("record_id")).alias("external_id"),
        (c("quality_status") == "ACCEPTED").alias("trusted"),
        (c("observed_at") - F.make_dt_interval(c("k") % 4)).alias("observed_at"),
    )
    return upsert_by_time(rows, ["listing_id"], ["availability"], ["external_id"])
