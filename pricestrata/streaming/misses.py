"""Missing products over time: runs missed before a sighting, and products that nobody sees again.

State is kept per product: the last settled sighting and the ones that still wait. A sighting is settled when the
watermark passes its run, so sightings may come in any order within the delay. An event-time timer stands at the
next thing that can happen to a product: the run of a waiting sighting, or the run at which enough runs are missed.
A product that is never seen again therefore gets its row from the timer, not from a later row of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

c = F.col

OUTCOMES = "channel string, product_id string, run_no int, outcome string, misses int"
_COLUMNS = ["channel", "product_id", "run_no", "outcome", "misses"]
_KEY = ["channel", "product_id"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class MissTracker(StatefulProcessor):
    """SEEN for each sighting, with the runs missed before it (none before the first); MISSING once ``threshold``
    runs in a row are missed; LATE for a sighting that contradicts what was already reported."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # due: when enough runs will be missed; null where there is no such run. missing: that was reported.
        self.last = handle.getValueState("last", "run_no int, due bigint, missing boolean")
        self.waiting = handle.getMapState("waiting", "run_no int", "at bigint, due bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1] is None:
            return
        last = self.last.get() if self.last.exists() else None
        late, first = set(), None
        for frame in rows:
            for run, at, due in frame[["run_no", "at", "due"]].drop_duplicates().itertuples(index=False):
                run, at = int(run), int(at)
                if last and run == last[0]:
                    continue
                if last and (run < last[0] or (last[2] and run <= last[0] + self.threshold)):
                    late.add(run)
                    continue
                self.waiting.updateValue((run,), (at, None if pd.isna(due) else int(due)))
                first = at if first is None else min(first, at)
        if first is not None:
            self.handle.registerTimer(first)
        if late:
            yield self._frame(key, [(run, "LATE", None) for run in sorted(late)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        last = self.last.get() if self.last.exists() else None
        out, ahead = [], []
        for (run,), (at, due) in sorted((tuple(k), tuple(v)) for k, v in self.waiting.iterator()):
            if at > now:
                ahead.append(at)
                continue
            if last and last[1] is not None and last[1] < at and not last[2]:
                out.append((last[0], "MISSING", self.threshold))
            out.append((run, "SEEN", run - last[0] - 1 if last else None))
            last = (run, due, False)
            self.waiting.removeKey((run,))
        if last and last[1] is not None and not last[2]:
            if last[1] <= now:
                out.append((last[0], "MISSING", self.threshold))
                last = (last[0], last[1], True)
            else:
                ahead.append(last[1])
        if last:
            self.last.update(tuple(last))
        if ahead:
            self.handle.registerTimer(min(ahead))
        if out:
            yield self._frame(key, out)

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(key, rows: list[tuple]) -> pd.DataFrame:
        frame = pd.DataFrame([(*key, *r) for r in rows], columns=_COLUMNS)
        return frame.astype({"run_no": "int32", "misses": "Int32"})


def _combined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each sighting once per batch of rows, before the shuffle: a product seen by very many rows sends few."""
    for frame in frames:
        yield frame.drop_duplicates()


def track(sightings: DataFrame, delay: str, threshold: int = 2) -> DataFrame:
    """Outcomes of a stream of sightings: channel, product_id, run_no, run_at and due_at.

    ``run_no`` numbers the complete runs of a channel, ``due_at`` is the time of the ``threshold``-th run after it. A row
    without a product only moves the watermark. Late rows are not filtered: they reach the state and are judged there.
    """
    timed = sightings.withColumn("run_at", c("run_at").cast("timestamp")).withWatermark("run_at", delay)
    # The watermark column itself stays behind, so that Spark drops no late row.
    rows = timed.select(
        *_KEY, c("run_no").cast("int").alias("run_no"), F.unix_millis("run_at").alias("at"),
        F.unix_millis(c("due_at").cast("timestamp")).alias("due"),
    )
    return (
        rows.mapInPandas(_combined, rows.schema)
        .groupBy(*_KEY)
        .transformWithStateInPandas(MissTracker(threshold), OUTCOMES, "append", "EventTime")
    )


def start(outcomes: DataFrame, root: str) -> StreamingQuery:
    """Append the outcomes to a table; timers need the state store with ordered keys, set for this stream alone."""
    spark = outcomes.sparkSession
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        return (
            outcomes.writeStream.format("parquet")
            .option("path", f"{root}/outcomes")
            .option("checkpointLocation", f"{root}/_checkpoint_outcomes")
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_PROVIDER, before)


def outcomes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(OUTCOMES).parquet(f"{root}/outcomes")
