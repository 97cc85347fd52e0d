"""Append, revisions, corrections, match intervals and pointers over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.operators import facts as ops
from pricestrata.operators import quality
from pricestrata.plans.batch import settle
from pricestrata.queries import query
from pricestrata.queries.prices import price_facts
from pricestrata.queries.sqltext import facts
from pricestrata.session import shared_folder
from pricestrata.sources import tables

c = F.col
CUT = "2024-01-20"


@query(
    "append_outcomes",
    "MRG-01 SRC-12",
    facts()
    + f"""SELECT event_id, observation_key, CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS deliveries,
           CASE WHEN observed_date >= DATE '{CUT}' THEN 'INSERT' WHEN k % 50 = 13 THEN 'CONFLICT'
                ELSE 'REPEAT' END AS outcome FROM facts""",
)
def append_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table arrives again, partly twice, at a store that already holds its first days.

    Batch and store are written tables: the batch is derived once, the store lies by day.
    """
    batch = settle(price_facts(spark, sf_dir), "append-batch")
    held = batch.where(c("observed_date") < F.lit(CUT).cast("date")).withColumn(
        "payload_hash", F.when(c("k") % 50 == 13, F.lit("torn")).otherwise(c("payload_hash"))
    )
    path = shared_folder(spark, "append-store")
    tables.append_facts(held, path)
    store = spark.read.schema(held.schema).parquet(path)
    twice = batch.unionByName(batch.where(c("event_id") % 7 == 0))
    return ops.classify_append(twice, store).select(
        "event_id", "observation_key", c("deliveries").cast("int").alias("deliveries"), "outcome"
    )


@query(
    "revision_numbers",
    "WIN-04 AGG-15 AGG-10",
    ctes("points")
    + """SELECT listing_id, identity_fingerprint, first_observed_at, last_observed_at,
           CAST(row_number() OVER (PARTITION BY listing_id ORDER BY first_seq) AS INT) AS revision_no
         FROM (SELECT listing_id, identity_fingerprint, min(observed_at) AS first_observed_at,
                 max(observed_at) AS last_observed_at, arg_min(ingest_seq, (observed_at, ingest_seq)) AS first_seq
               FROM points GROUP BY ALL)""",
)
def revision_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.revision_numbers(bind.frame(spark, sf_dir, "points"))


@query(
    "current_revisions",
    "WIN-05",
    ctes("publications")
    + """, f AS (SELECT listing_id, revision_id, max(CASE WHEN observed_at = DATE '2024-01-23' THEN DATE '2024-01-22'
               ELSE observed_at END) AS t FROM publications WHERE observed_at <= DATE '2024-01-23'
             GROUP BY listing_id, revision_id),
         g AS (SELECT *, max(t) OVER (PARTITION BY listing_id) AS top FROM f)
         SELECT listing_id, min(revision_id) AS revision_id, max(t) AS trusted_at, count(*) > 1 AS conflict
         FROM g WHERE t = top GROUP BY listing_id""",
)
def current_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day precision, with the day of a revision switch folded onto the day before it."""
    rows = bind.frame(spark, sf_dir, "publications").where("observed_at <= DATE '2024-01-23'")
    folded = F.when(
        c("observed_at") == F.lit("2024-01-23").cast("date"), F.lit("2024-01-22").cast("date")
    ).otherwise(c("observed_at"))
    return ops.current_revision(rows.withColumn("observed_at", folded))


@query(
    "same_time_conflicts",
    "WIN-07",
    ctes("publications")
    + """SELECT listing_id, region_scope, region_code, observed_at, count(DISTINCT base_key) AS distinct_keys,
           count(*) AS facts FROM publications GROUP BY ALL HAVING count(DISTINCT base_key) > 1""",
)
def same_time_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "publications").withColumn("observation_key", c("base_key"))
    return ops.same_time_conflicts(rows)


_CHAIN = """
firsts AS (SELECT * FROM publications QUALIFY row_number() OVER (
    PARTITION BY listing_id, revision_id, observed_at, source_hash, payload_hash ORDER BY ingest_seq) = 1),
chain AS (SELECT *, lag(base_key) OVER (PARTITION BY listing_id, revision_id, observed_at
    ORDER BY ingest_seq) AS supersedes_key FROM firsts)"""


@query(
    "correction_chain",
    "WIN-08",
    ctes("publications", extra=_CHAIN)
    + "SELECT ingest_seq, listing_id, revision_id, observed_at, base_key, supersedes_key FROM chain",
)
def correction_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.correction_chain(bind.frame(spark, sf_dir, "publications")).select(
        "ingest_seq", "listing_id", "revision_id", "observed_at", "base_key", "supersedes_key"
    )


bind.VIEWS["matches"] = """
SELECT ingest_seq, revision_id, region_code || '/' || CAST(k % 7 AS STRING) AS variant_id,
       CASE WHEN k % 6 = 0 THEN '2' ELSE '1' END AS matcher_version, k,
       observed_at AS arrived_at
FROM {points} WHERE quality_status = 'ACCEPTED'
"""
_BACK = "date_trunc('day', arrived_at) - to_days(CAST(k % 5 AS INTEGER))"


@query(
    "match_intervals",
    "WIN-06",
    ctes(
        "matches",
        extra=f"""f AS (SELECT *, {_BACK} AS effective_from FROM matches QUALIFY row_number() OVER (
             PARTITION BY revision_id, variant_id, matcher_version ORDER BY ingest_seq) = 1),
           b AS (SELECT *, coalesce(effective_from < max(effective_from) OVER (PARTITION BY revision_id
               ORDER BY ingest_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS backwards FROM f)""",
    )
    + """SELECT ingest_seq, revision_id, variant_id, effective_from, backwards,
           CASE WHEN NOT backwards THEN lead(effective_from) OVER (PARTITION BY revision_id, backwards
             ORDER BY ingest_seq) END AS effective_to FROM b""",
)
def match_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = (F.date_trunc("DAY", "arrived_at") - F.make_dt_interval(c("k") % 5)).cast("timestamp_ntz")
    rows = bind.frame(spark, sf_dir, "matches").withColumn("effective_from", start)
    return ops.match_intervals(rows).select(
        "ingest_seq", "revision_id", "variant_id", "effective_from", "backwards", "effective_to"
    )


_POINTER = "listing_id, region_scope, region_code, observation_key, observed_at"


@query(
    "advanced_pointers",
    "MRG-04",
    ctes("points")
    + f"""SELECT {_POINTER} FROM points WHERE quality_status = 'ACCEPTED'
          QUALIFY row_number() OVER (PARTITION BY listing_id, region_scope, region_code
            ORDER BY observed_at DESC, ingest_seq DESC) = 1""",
)
def advanced_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest days first, the older days arrive late: pointers must not move back."""
    rows = bind.frame(spark, sf_dir, "points").where("quality_status = 'ACCEPTED'")
    late = rows.where(c("observed_date") < F.lit("2024-01-15").cast("date"))
    recent = rows.where(c("observed_date") >= F.lit("2024-01-15").cast("date"))
    pointers = ops.newest(
        recent.select(*ops.POINTER), ops.REGION, [c("observed_at"), c("ingest_seq")]
    )
    return ops.advance_current(pointers, late).select(*_POINTER.split(", "))


@query(
    "corrected_projection",
    "WIN-01 MRG-04",
    ctes("publications", extra=_CHAIN)
    + """, live AS (SELECT * FROM chain x WHERE NOT EXISTS (
           SELECT 1 FROM chain y WHERE y.supersedes_key = x.base_key)),
         top AS (SELECT listing_id, max(observed_at) AS t FROM live GROUP BY 1)
         SELECT live.listing_id, live.revision_id, live.base_key, live.observed_at FROM live
         JOIN top ON live.listing_id = top.listing_id
         WHERE live.observed_at = (SELECT max(observed_at) FROM live z WHERE z.listing_id = live.listing_id
               AND z.revision_id = live.revision_id)
           AND live.observed_at = top.t""",
)
def corrected_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = ops.correction_chain(bind.frame(spark, sf_dir, "publications"))
    rows = chain.withColumn("observation_key", c("base_key"))
    return ops.rebuild_current(rows).select(
        "listing_id", "revision_id", c("observation_key").alias("base_key"), "observed_at"
    )


@query(
    "switched_pointers",
    "MRG-05",
    ctes(
        "points",
        extra="""a AS (SELECT * FROM points WHERE quality_status = 'ACCEPTED'),
          cur AS (SELECT listing_id, arg_max(revision_id, observed_at) AS revision_id FROM a GROUP BY 1)""",
    )
    + f"""SELECT a.{_POINTER.replace(', ', ', a.')}, a.revision_id FROM a
          JOIN cur USING (listing_id, revision_id)
          QUALIFY row_number() OVER (PARTITION BY a.listing_id, a.region_scope, a.region_code
            ORDER BY a.observed_at DESC, a.ingest_seq DESC) = 1""",
)
def switched_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pointers of day 20 meet the facts of the month; listings that switched are rebuilt."""
    rows = bind.frame(spark, sf_dir, "points")
    old = rows.where(c("observed_date") <= F.lit(CUT).cast("date"))
    unswitched = ops.advance_current(
        ops.rebuild_current(old),
        rows.join(ops.current_revision(old).select("listing_id", "revision_id"),
                  ["listing_id", "revision_id"], "left_semi")
        .where("quality_status = 'ACCEPTED'"),
    )
    return ops.switch_revisions(unswitched, rows).select(*_POINTER.split(", "), "revision_id")


@query(
    "merged_seen_ranges",
    "AGG-10 MRG-03",
    ctes("points")
    + """SELECT channel, product_id, min(observed_at) AS first_seen_at, max(observed_at) AS last_seen_at
         FROM points GROUP BY ALL""",
)
def merged_seen_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "points")
    key = ["channel", "product_id"]
    old = quality.seen_range(rows.where(c("observed_date") < F.lit(CUT).cast("date")), key, "observed_at")
    new = quality.seen_range(rows.where(c("observed_date") >= F.lit(CUT).cast("date")), key, "observed_at")
    return quality.merge_seen_range(old, new, key)
