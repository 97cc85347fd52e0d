"""Large-change hold as split state transitions.

The verdict of a price depends on the last trusted price and on a held one, so a listing is a chain. A chain is cut
into time slices, and a slice is reduced to a map from the state before it to the state after it:
which row would be the first trusted one depends on the last trusted price alone, piece by piece of its
range, and from that row on nothing before matters. Maps compose, so the states before all slices come from a
prefix scan in two levels (slices in sections, sections in a listing), and slices judge their rows by themselves.
No task holds more rows of a listing than a slice, or more maps than a section or the sections of a listing.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricestrata.session import path_exists
from pricestrata.streaming import prices

c = F.col
KEY = ["listing_id", "region_scope", "region_code"]
#: Width of a slice, and slices in a section.
SLICE_MS = 86_400_000
SECTION = 64


class State(NamedTuple):
    """Last trusted price and its time; held price, its time and row."""

    cents: int | None = None
    at: int | None = None
    held_cents: int | None = None
    held_at: int | None = None
    held_seq: int | None = None


class Limit(NamedTuple):
    """A jump is a change by more than num / den; a hold waits ``wait`` microseconds."""

    num: int
    den: int
    wait: int

    def jumps(self, before: int, now: int) -> bool:
        return abs(now - before) * self.den > self.num * before

    def calm(self, now: int) -> tuple[int, int]:
        """The last prices, from and to, after which ``now`` is no jump."""
        low = -(-now * self.den // (self.den + self.num))
        return low, now * self.den // (self.den - self.num) if self.den > self.num else 1 << 62


def limit_of(threshold: str, wait_ms: int) -> Limit:
    share = Fraction(threshold)
    return Limit(share.numerator, share.denominator, wait_ms * 1_000)


def judge(state: State, rows: list[tuple[int, int, int]], limit: Limit) -> tuple[State, list[tuple[int, str]]]:
    """State after (time, cents, row) in order, and the verdicts: one per row, one more for a held row that is settled."""
    cents, at, held_cents, held_at, held = state
    out: list[tuple[int, str]] = []
    for now, price, seq in rows:
        if at is not None and now <= at:
            out.append((seq, "HISTORY"))
            continue
        if held is not None and now - held_at > limit.wait:
            out.append((held, "PRICE_CHANGE_UNCONFIRMED"))
            held = None
        jump = cents is not None and limit.jumps(cents, price)
        if jump and (held is None or held_cents != price or now <= held_at):
            if held is not None:
                out.append((held, "PRICE_CHANGE_UNCONFIRMED"))
            held_cents, held_at, held = price, now, seq
            out.append((seq, "HELD"))
            continue
        if held is not None:
            out.append((held, "CONFIRMED" if jump else "PRICE_CHANGE_UNCONFIRMED"))
            held = None
        out.append((seq, "TRUSTED"))
        cents, at = price, now
    return State(cents, at, *((held_cents, held_at, held) if held is not None else (None, None, None))), out


class Move(NamedTuple):
    """What rows do to a state that is older than they are.

    ``first``: time and price of the first row; ``start``: the state after all if that row is
    trusted, as it is without a last price or when it repeats the held one. ``pieces``: ranges of last
    prices, in order and apart, with the state after; ``rest``: the state for all other last prices, or
    None where no row is trusted: then the last price stays and ``last`` (time, price, row) is held.
    """

    first: tuple[int, int]
    start: State
    pieces: list[tuple[int, int, State]]
    rest: State | None
    last: tuple[int, int, int]

    def after(self, state: State, limit: Limit) -> State:
        repeats = state.held_seq is not None and state.held_cents == self.first[1]
        if state.cents is None or (repeats and 0 < self.first[0] - state.held_at <= limit.wait):
            return self.start
        i = bisect_right(self.pieces, state.cents, key=itemgetter(0)) - 1
        if i >= 0 and state.cents <= self.pieces[i][1]:
            return self.pieces[i][2]
        if self.rest is not None:
            return self.rest
        at, price, seq = self.last
        return State(state.cents, state.at, price, at, seq)

    def then(self, more: Move, limit: Limit) -> Move:
        """This move and ``more`` after it as one."""
        done = [(low, high, more.after(end, limit)) for low, high, end in self.pieces]
        start = more.after(self.start, limit)
        if self.rest is not None:
            return Move(self.first, start, done, more.after(self.rest, limit), more.last)
        at, price, _ = self.last
        if price == more.first[1] and 0 < more.first[0] - at <= limit.wait:
            return Move(self.first, start, done, more.start, more.last)
        return Move(self.first, start, filled(done, more.pieces), more.rest, more.last)


def filled(known: list[tuple], others: list[tuple]) -> list[tuple]:
    """Pieces of ``known``, and those of ``others`` where ``known`` has none; equal neighbours joined."""
    out = list(known)
    for low, high, end in others:
        for a, b, _ in known:
            if b < low or a > high:
                continue
            if a > low:
                out.append((low, a - 1, end))
            low = b + 1
            if low > high:
                break
        if low <= high:
            out.append((low, high, end))
    out.sort(key=itemgetter(0))
    joined: list[tuple] = []
    for low, high, end in out:
        if joined and joined[-1][2] == end and joined[-1][1] + 1 == low:
            joined[-1] = (joined[-1][0], high, end)
        else:
            joined.append((low, high, end))
    return joined


def move_of(rows: list[tuple[int, int, int]], limit: Limit) -> Move:
    """The move of (time, cents, row) in order."""
    whole: Move | None = None
    for at, same in groupby(rows, key=itemgetter(0)):
        instant = list(same)
        # Of one instant the first price without a jump counts; all later ones are history.
        pieces: list[tuple] = []
        for _, price, _ in instant:
            pieces = filled(pieces, [(*limit.calm(price), State(price, at))])
        own = Move((at, instant[0][1]), State(instant[0][1], at), pieces, None, instant[-1])
        whole = own if whole is None else whole.then(own, limit)
    return whole


def packed(move: Move) -> str:
    return json.dumps(move)


def unpacked(text: str) -> Move:
    first, start, pieces, rest, last = json.loads(text)
    return Move(
        tuple(first), State(*start), [(a, b, State(*end)) for a, b, end in pieces],
        None if rest is None else State(*rest), tuple(last),
    )


# --- a micro-batch


def by_group(
    df: DataFrame, part: list[str], order: list[str], step: Callable[[tuple, list[tuple]], Iterator[tuple]], schema: str
) -> DataFrame:
    """``step(key, rows)`` of each group, its rows in order and without the key; groups follow each other in a
    task, one at a time is held."""
    rest = [n for n in df.columns if n not in part]
    rows = df.select(*part, *rest).repartition(*part).sortWithinPartitions(*part, *order)
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]
    k = len(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for key, group in groupby(every(), key=lambda r: r[:k]):
            out += [(*key, *row) for row in step(key, [r[k:] for r in group])]
            if len(out) >= 20_000:
                yield made()
                out = []
        yield made()

    return rows.mapInArrow(run, schema)


_KEYED = "listing_id string, region_scope string, region_code string, "
STATE = _KEYED + "cents bigint, at bigint, held_cents bigint, held_at bigint, held_seq bigint"
_FIELDS = State._fields


def verdicts_of(rows: DataFrame, states: DataFrame, limit: Limit, write: Callable[[DataFrame, str], DataFrame], slice_ms: int):
    """(verdicts, states after) of new rows (KEY, at, cents, ingest_seq) and the states before, of which
    those without new rows stay.

    ``write`` stores a table under a name and reads it back, so that a step is computed once.
    """
    width = slice_ms * 1_000
    known = rows.join(states.select(*KEY, c("at").alias("last_at")), KEY, "left")
    known = write(known.withColumn("slice", F.floor(c("at") / width)), "rows")
    late = c("last_at").isNotNull() & (c("at") <= c("last_at"))
    history = known.where(late).select(*KEY, "ingest_seq", F.lit("HISTORY").alias("verdict"))
    fresh = known.where(~late).select(*KEY, "slice", "at", "cents", "ingest_seq")
    part = [*KEY, "slice"]
    moves = by_group(
        fresh, part, ["at", "ingest_seq"], lambda _, r: iter([(packed(move_of(r, limit)),)]), _KEYED + "slice bigint, move string"
    )
    moves = write(moves.withColumn("section", F.floor(c("slice") / SECTION)), "moves")

    def composed(_: tuple, group: list[tuple]) -> Iterator[tuple]:
        whole = None
        for _, text in group:
            move = unpacked(text)
            whole = move if whole is None else whole.then(move, limit)
        yield (packed(whole),)

    sections = by_group(moves, [*KEY, "section"], ["slice"], composed, _KEYED + "section bigint, move string")
    none = F.lit(None)

    def scan(_: tuple, group: list[tuple]) -> Iterator[tuple]:
        """The state before each place, and at the end (place null) the one after all; a row without a
        move brings the state before the first place."""
        state = State()
        for place, text, *fields in group:
            if text is None:
                state = State(*fields)
                continue
            yield place, *state
            state = unpacked(text).after(state, limit)
        yield None, *state

    numbers = ", ".join(f"{n} bigint" for n in _FIELDS)
    order = F.lit(-(1 << 62)).cast("bigint")
    chain = states.select(*KEY, order.alias("section"), none.cast("string").alias("move"), *_FIELDS).unionByName(
        sections.select(*KEY, "section", "move", *[none.cast("bigint").alias(n) for n in _FIELDS])
    )
    before = write(by_group(chain, KEY, ["section"], scan, _KEYED + "section bigint, " + numbers), "sections")
    after = before.where(c("section").isNull()).drop("section")
    chain = before.where(c("section").isNotNull()).select(
        *KEY, "section", order.alias("slice"), none.cast("string").alias("move"), *_FIELDS
    ).unionByName(moves.select(*KEY, "section", "slice", "move", *[none.cast("bigint").alias(n) for n in _FIELDS]))
    inside = by_group(chain, [*KEY, "section"], ["slice"], scan, _KEYED + "section bigint, slice bigint, " + numbers)
    inside = inside.where(c("slice").isNotNull()).select(*part, *_FIELDS)

    def judged(_: tuple, group: list[tuple]) -> Iterator[tuple]:
        state = State()
        rows = []
        for _, at, cents, seq, *fields in group:
            if seq is None:
                state = State(*fields)
            else:
                rows.append((at, cents, seq))
        yield from judge(state, rows, limit)[1]

    led = inside.select(
        *part, F.lit(0).alias("kind"), none.cast("bigint").alias("time"), none.cast("bigint").alias("price"),
        none.cast("bigint").alias("ingest_seq"), *_FIELDS,
    ).unionByName(
        fresh.select(
            *part, F.lit(1).alias("kind"), c("at").alias("time"), c("cents").alias("price"), "ingest_seq",
            *[none.cast("bigint").alias(n) for n in _FIELDS],
        )
    )
    found = by_group(led, part, ["kind", "time", "ingest_seq"], judged, _KEYED + "slice bigint, ingest_seq bigint, verdict string")
    return history.unionByName(found.drop("slice")), after


def hold_changes(
    stream: DataFrame, root: str, threshold: str = "0.30", wait_ms: int = 86_400_000, slice_ms: int = SLICE_MS, buckets: int = 16
) -> StreamingQuery:
    """Judge every priced row of a stream; verdicts and states lie below ``root``.

    A row is TRUSTED, HISTORY (not after the last trusted time) or HELD; a held row gets a second verdict when it is
    settled: CONFIRMED by a repeat, PRICE_CHANGE_UNCONFIRMED by another price or by a capture more than
    ``wait_ms`` later. States lie in buckets of their listing, and a batch rewrites those that it touches.
    """
    limit = limit_of(threshold, wait_ms)
    bucket = F.pmod(F.xxhash64("listing_id"), F.lit(buckets)).cast("int")

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        work = f"{root}/work/{batch_id}"

        def write(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{work}/{name}")
            return spark.read.schema(df.schema).parquet(f"{work}/{name}")

        rows = batch.where((c("quality_status") == "ACCEPTED") & c("current_price").isNotNull()).select(
            *KEY, "ingest_seq", F.unix_micros(c("observed_at").cast("timestamp")).alias("at"),
            (c("current_price") * 100).cast("bigint").alias("cents"),
        )
        rows = write(rows, "input")
        # At most as many values as there are buckets.
        touched = {r[0] for r in rows.select(bucket.alias("b")).distinct().collect()}
        heads = prices._heads(spark, root, batch_id - 1, "holds")
        own = {b: v for b, v in heads.items() if b in touched}
        schema = spark.createDataFrame([], STATE).schema
        states = prices._pointers(spark, root, own, schema, "holds")
        verdicts, after = verdicts_of(rows, states, limit, write, slice_ms)
        verdicts.write.mode("overwrite").parquet(f"{root}/verdicts/batch_id={batch_id}")
        (
            after.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket")
            .parquet(f"{root}/holds/v={batch_id}")
        )
        heads |= dict.fromkeys(touched, batch_id)
        prices._note(spark, root, batch_id, heads, "holds")

    return prices._start(stream, each, root, "holds")


def settled(verdicts: DataFrame) -> DataFrame:
    """The last verdict of every row: a row is HELD only while nothing has settled it."""
    key = [*KEY, "ingest_seq"]
    return verdicts.groupBy(*key).agg(F.max_by("verdict", c("verdict") != "HELD").alias("verdict"))


def read_verdicts(spark, root: str) -> DataFrame:
    schema = _KEYED + "ingest_seq bigint, verdict string"
    path = f"{root}/verdicts"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
