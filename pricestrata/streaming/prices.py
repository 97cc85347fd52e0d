"""Streaming forms of ingest, pointers, change hold, miss counting and routing.

Tables live in the shared folder. Every micro-batch writes to a place named by its batch id, so
a batch that is run again after a failure overwrites its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricestrata.operators.facts import POINTER, advance_current, days_of, first_arrivals, on_days
from pricestrata.session import path_exists

c = F.col


def events_stream(
    spark: SparkSession, folder: str, pattern: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of a folder as a stream; the caller may bound the files of a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(path)


def _start(
    stream: DataFrame, each: Callable[[DataFrame, int], None], root: str, name: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", f"{root}/_checkpoint_{name}")
        .trigger(availableNow=True)
        .start()
    )


def ingest(stream: DataFrame, root: str) -> StreamingQuery:
    """Append each observation once, however late it comes.

    There is no watermark on this path: every batch is reduced to the first arrival per key and
    compared with the stored keys of its own days, read by a literal day filter.
    """
    path = f"{root}/facts"

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        key = ["observed_date", "observation_key"]
        batch.persist()
        try:
            known = _stored(spark, path, batch.withColumn("batch_id", F.lit(0).cast("bigint")))
            # A batch that runs again must not see what its first run wrote.
            earlier = on_days(known.where(c("batch_id") < batch_id), days_of(batch)).select(*key)
            (
                first_arrivals(batch, key)
                .join(earlier, key, "left_anti")
                .write.mode("overwrite")
                .partitionBy("observed_date")
                .parquet(f"{path}/batch_id={batch_id}")
            )
        finally:
            batch.unpersist()

    return _start(stream, append, root, "ingest")


def _heads(spark: SparkSession, root: str, batch_id: int, name: str = "current") -> dict[int, int]:
    """The version that each bucket of a table has after a batch."""
    path = f"{root}/{name}/heads/v={batch_id}"
    if batch_id < 0 or not path_exists(spark, path):
        return {}
    return {r["bucket"]: r["version"] for r in spark.read.parquet(path).collect()}


def _note(spark: SparkSession, root: str, batch_id: int, heads: dict[int, int], name: str = "current") -> None:
    rows = spark.createDataFrame(sorted(heads.items()), "bucket int, version bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}/heads/v={batch_id}")


def _pointers(
    spark: SparkSession, root: str, heads: dict[int, int], schema, name: str = "current"
) -> DataFrame:
    paths = [f"{root}/{name}/v={v}/bucket={b}" for b, v in sorted(heads.items())]
    paths = [x for x in paths if path_exists(spark, x)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def current_pointers(spark: SparkSession, root: str, batch_id: int, schema) -> DataFrame:
    """The pointer table as it stands after a batch."""
    return _pointers(spark, root, _heads(spark, root, batch_id), schema)


def _advance(batch: DataFrame, batch_id: int, root: str, buckets: int) -> DataFrame:
    """Move the pointers of the buckets that a batch touches; returns these buckets.

    Pointers lie in buckets of their listing. A batch writes the buckets it touches as a new
    version and a list of the newest version per bucket; all other buckets stay as they are.
    Versions that no kept list names may be deleted.
    """
    spark = batch.sparkSession
    bucket = F.pmod(F.xxhash64("listing_id"), F.lit(buckets)).cast("int")
    names = [*POINTER, *(x for x in ("base_key", "supersedes_key") if x in batch.columns)]
    accepted = batch.where("quality_status = 'ACCEPTED'").select(*names)
    stored = accepted.drop("supersedes_key")
    accepted.persist()
    try:
        # At most as many values as there are buckets.
        touched = {r[0] for r in accepted.select(bucket.alias("b")).distinct().collect()}
        heads = _heads(spark, root, batch_id - 1)
        own = {b: v for b, v in heads.items() if b in touched}
        now = advance_current(_pointers(spark, root, own, stored.schema), accepted)
        path = f"{root}/current/v={batch_id}"
        now.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(path)
    finally:
        accepted.unpersist()
    heads |= dict.fromkeys(touched, batch_id)
    _note(spark, root, batch_id, heads)
    return _pointers(spark, root, dict.fromkeys(touched, batch_id), stored.schema)


def follow_current(stream: DataFrame, root: str, buckets: int = 16) -> StreamingQuery:
    """Pointer table: merge accepted facts, a late fact never moves a pointer back."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        _advance(batch, batch_id, root, buckets)

    return _start(stream, merge, root, "current")


def route(stream: DataFrame, root: str, buckets: int = 16) -> StreamingQuery:
    """Split every batch: new pointers, accepted history, and rows kept for audit only."""
    key = ["listing_id", "region_scope", "region_code"]

    def split(batch: DataFrame, batch_id: int) -> None:
        written = _advance(batch, batch_id, root, buckets)
        tip = written.select(*key, c("ingest_seq").alias("tip_seq"))
        lane = (
            F.when(c("quality_status") != "ACCEPTED", "AUDIT")
            .when(c("ingest_seq") == c("tip_seq"), "CURRENT")
            .otherwise("HISTORY")
        )
        (
            batch.join(tip, key, "left")
            .withColumn("lane", lane)
            .select("ingest_seq", *key, "lane")
            .write.mode("overwrite")
            .partitionBy("lane")
            .parquet(f"{root}/routed/batch_id={batch_id}")
        )

    return _start(stream, split, root, "route")


MISS_OUTPUT = "channel string, product_id string, run_no int, misses_before int, late boolean"


def count_misses(sightings: DataFrame) -> DataFrame:
    """Runs missed before every sighting of a product; state is its last run number.

    ``sightings`` carries the number of the complete run; absences need no rows of their own.
    A run before the last one seen is reported as late, without a count; a repeat of the last one is dropped.
    """

    def step(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        runs = sorted({int(n) for frame in frames for n in frame["run_no"]})
        late = [n for n in runs if last is not None and n < last]
        fresh = [n for n in runs if last is None or n > last]
        before = [last, *fresh[:-1]] if fresh else []
        misses = [None if b is None else n - b - 1 for n, b in zip(fresh, before, strict=True)]
        if fresh:
            state.update((fresh[-1],))
        yield pd.DataFrame(
            {
                "channel": key[0],
                "product_id": key[1],
                "run_no": pd.Series([*late, *fresh], dtype="int32"),
                "misses_before": pd.Series([*[None] * len(late), *misses], dtype="Int32"),
                "late": pd.Series([*[True] * len(late), *[False] * len(fresh)], dtype="bool"),
            }
        )

    return (
        sightings.select("channel", "product_id", "run_no")
        .groupBy("channel", "product_id")
        .applyInPandasWithState(step, MISS_OUTPUT, "last int", "append", GroupStateTimeout.NoTimeout)
    )


def write_stream(result: DataFrame, root: str, name: str) -> StreamingQuery:
    """Append a stream to a parquet table; the sink's log makes a repeated batch a no-op."""
    return (
        result.writeStream.format("parquet")
        .option("path", f"{root}/{name}")
        .option("checkpointLocation", f"{root}/_checkpoint_{name}")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
