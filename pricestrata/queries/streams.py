"""Streams over the events file, run to the end of the input and read back from their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.operators.facts import POINTER
from pricestrata.operators.guards import number_runs
from pricestrata.queries import query
from pricestrata.queries.guarding import _STREAKS
from pricestrata.session import shared_folder, table
from pricestrata.streaming import holds, misses
from pricestrata.streaming import prices as ops

c = F.col


def point_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = ops.events_stream(spark, sf_dir, "events.parquet", table(spark, sf_dir, "events").schema)
    return bind.frame(spark, sf_dir, "points", {"events": events})


def deliver_late(
    spark: SparkSession, sf_dir: str, root: str, run: Callable[[DataFrame], StreamingQuery]
) -> StreamingQuery:
    """All events in three deliveries: the last days first, the first days last, then a part of
    each again. Each is written as it is split into a folder of its own, and the stream that
    ``run`` starts comes to its end before the next one; returns the last run."""
    events = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts")
    parts = (day > 20, day <= 10, ((day > 10) & (day <= 20)) | (c("event_id") % 5 == 0))
    for k, part in enumerate(parts):
        events.where(part).write.mode("overwrite").parquet(f"{root}/events/{k}")
        stream = ops.events_stream(spark, f"{root}/events/*", "*.parquet", events.schema)
        running = run(bind.frame(spark, sf_dir, "points", {"events": stream}))
        running.awaitTermination()
    return running


@query(
    "stream_ingest",
    "STR-01",
    ctes("points") + "SELECT ingest_seq, observation_key, observed_date FROM points",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries come late and twice, and some rows twice in one; the table holds each once."""
    root = shared_folder(spark, "stream-ingest")
    copies = F.when(c("ingest_seq") % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    deliver_late(
        spark, sf_dir, root,
        lambda late: ops.ingest(late.withColumn("copy", F.explode(copies)).drop("copy"), root),
    )
    return spark.read.parquet(f"{root}/facts").select("ingest_seq", "observation_key", "observed_date")


@query(
    "stream_current",
    "STR-02",
    ctes("points")
    + """SELECT listing_id, region_scope, region_code, observation_key, observed_at FROM points
         WHERE quality_status = 'ACCEPTED' QUALIFY row_number() OVER (
           PARTITION BY listing_id, region_scope, region_code ORDER BY observed_at DESC, ingest_seq DESC) = 1""",
)
def stream_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "stream-current")
    running = deliver_late(spark, sf_dir, root, lambda late: ops.follow_current(late, root))
    batch_id = running.lastProgress["batchId"]
    schema = bind.frame(spark, sf_dir, "points").select(*POINTER).schema
    return ops.current_pointers(spark, root, batch_id, schema).select(
        "listing_id", "region_scope", "region_code", "observation_key", "observed_at"
    )


@query(
    "stream_change_hold",
    "STR-03",
    ctes("points").replace("WITH ", "WITH RECURSIVE ", 1)
    + """, p AS (SELECT listing_id, region_scope, region_code, ingest_seq, observed_at AS tm,
             CAST(current_price * 100 AS BIGINT) AS cents, row_number() OVER (
               PARTITION BY listing_id, region_scope, region_code ORDER BY observed_at, ingest_seq) AS n
           FROM points WHERE quality_status = 'ACCEPTED' AND current_price IS NOT NULL),
         s AS (SELECT listing_id, region_scope, region_code, n, cents AS last_cents, tm AS last_at,
             CAST(NULL AS BIGINT) AS held_cents, CAST(NULL AS TIMESTAMP) AS held_at, CAST(NULL AS BIGINT) AS held_seq,
             CAST(NULL AS BIGINT) AS gone_seq, CAST(NULL AS VARCHAR) AS gone, ingest_seq, 'TRUSTED' AS verdict
           FROM p WHERE n = 1
           UNION ALL
           SELECT listing_id, region_scope, region_code, n,
             CASE WHEN v = 'TRUSTED' THEN cents ELSE last_cents END, CASE WHEN v = 'TRUSTED' THEN tm ELSE last_at END,
             CASE v WHEN 'HELD' THEN cents WHEN 'HISTORY' THEN held_cents END,
             CASE v WHEN 'HELD' THEN tm WHEN 'HISTORY' THEN held_at END,
             CASE v WHEN 'HELD' THEN ingest_seq WHEN 'HISTORY' THEN held_seq END,
             CASE WHEN v <> 'HISTORY' THEN held_seq END,
             CASE WHEN v = 'TRUSTED' AND jump AND NOT stale THEN 'CONFIRMED' ELSE 'PRICE_CHANGE_UNCONFIRMED' END,
             ingest_seq, v
           FROM (SELECT *, CASE WHEN tm <= last_at THEN 'HISTORY'
                   WHEN jump AND (held_seq IS NULL OR stale OR held_cents <> cents OR tm <= held_at) THEN 'HELD'
                   ELSE 'TRUSTED' END AS v
             FROM (SELECT p.*, s.last_cents, s.last_at, s.held_cents, s.held_at, s.held_seq,
                 abs(p.cents - s.last_cents) * 10 > 3 * s.last_cents AS jump,
                 coalesce(p.tm > s.held_at + INTERVAL 1 DAY, false) AS stale
               FROM s JOIN p ON p.listing_id = s.listing_id AND p.region_scope = s.region_scope
                 AND p.region_code = s.region_code AND p.n = s.n + 1) x) y)
         SELECT a.listing_id, a.region_scope, a.region_code, a.ingest_seq, coalesce(b.gone, a.verdict) AS verdict
         FROM s a LEFT JOIN s b ON b.gone_seq = a.ingest_seq AND b.listing_id = a.listing_id
           AND b.region_scope = a.region_scope AND b.region_code = a.region_code""",
)
def stream_change_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "stream-hold")
    holds.hold_changes(point_stream(spark, sf_dir), root).awaitTermination()
    return holds.settled(holds.read_verdicts(spark, root))


@query(
    "stream_miss_counter",
    "STR-04",
    ctes("runs", "sightings", extra=_STREAKS)
    + """SELECT channel, product_id, CAST(run_no AS INT) AS run_no,
           CAST(run_no - lag(run_no) OVER (PARTITION BY channel, product_id ORDER BY run_no) - 1 AS INT) AS misses_before,
           false AS late FROM seen""",
)
def stream_miss_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "stream-misses")
    runs = number_runs(bind.frame(spark, sf_dir, "runs")).select("channel", "run_at", "run_no")
    seen = point_stream(spark, sf_dir).where("region_scope = 'NATIONAL'").select(
        "channel", "product_id", c("observed_date").alias("run_at")
    )
    numbered = seen.join(runs, ["channel", "run_at"])
    ops.write_stream(ops.count_misses(numbered), root, "misses").awaitTermination()
    return spark.read.schema(ops.MISS_OUTPUT).parquet(f"{root}/misses")


@query(
    "stream_missing",
    "STR-04 WIN-09",
    ctes("runs", "sightings", extra=_STREAKS)
    + """SELECT channel, product_id, CAST(run_no AS INT) AS run_no, 'SEEN' AS outcome,
           CAST(run_no - lag(run_no) OVER (PARTITION BY channel, product_id ORDER BY run_no) - 1 AS INT) AS misses FROM seen
         UNION ALL SELECT channel, product_id, run_no, 'MISSING', CAST(2 AS INT) FROM streaks WHERE candidate""",
)
def stream_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in three deliveries by time, each up to four days late and a fifth of them again after six; at the end a
    clock row says that no run is outstanding, so products that nobody sees again are missed by their timers."""
    root = shared_folder(spark, "stream-missing")
    events = table(spark, sf_dir, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    runs = number_runs(bind.frame(spark, sf_dir, "runs")).select("channel", "run_at", "run_no")
    due = runs.select("channel", (c("run_no") - 2).alias("run_no"), c("run_at").alias("due_at"))
    dated = runs.join(due, ["channel", "run_no"], "left")
    clock = spark.createDataFrame([], "run_at timestamp")

    def delivery(days: Column) -> Column:
        span = (high - low).days + 1 if low is not None else 1
        return F.least(F.lit(2), F.floor((F.datediff("ts", F.lit(low)) + days) * 3 / F.lit(span)))

    days_late = c("event_id") % 5
    for k in range(3):
        part = (delivery(days_late) == k) | ((days_late == 0) & (delivery(F.lit(6)) == k))
        events.where(part).write.parquet(f"{root}/events/{k}")
        if k == 2 and high is not None:
            clock = spark.range(1).select((F.lit(high) + F.expr("INTERVAL 8 DAYS")).cast("timestamp").alias("run_at"))
        clock.write.parquet(f"{root}/clock/{k}")
        stream = bind.frame(spark, sf_dir, "points", {
            "events": ops.events_stream(spark, f"{root}/events/*", "*.parquet", events.schema)
        })
        seen = (
            stream.where("region_scope = 'NATIONAL'")
            .select("channel", "product_id", c("observed_date").alias("run_at"))
            .join(dated, ["channel", "run_at"])
            .withColumn("run_at", c("run_at").cast("timestamp"))
        )
        closed = ops.events_stream(spark, f"{root}/clock/*", "*.parquet", clock.schema)
        misses.start(misses.track(seen.unionByName(closed, True), "7 days", 2), root).awaitTermination()
    return misses.outcomes(spark, root)


@query(
    "stream_routes",
    "STR-05",
    ctes("points")
    + """SELECT ingest_seq, CASE WHEN quality_status <> 'ACCEPTED' THEN 'AUDIT' WHEN row_number() OVER (
             PARTITION BY listing_id, region_scope, region_code, quality_status = 'ACCEPTED'
             ORDER BY observed_at DESC, ingest_seq DESC) = 1 THEN 'CURRENT' ELSE 'HISTORY' END AS lane FROM points""",
)
def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "stream-routes")
    ops.route(point_stream(spark, sf_dir), root).awaitTermination()
    return spark.read.parquet(f"{root}/routed").select("ingest_seq", "lane")
