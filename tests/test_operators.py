"""Operators against brute force on small, skewed fixtures, and state rules over batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.checks import audit
from pricestrata.operators import facts, lookups, ordered
from pricestrata.queries import audits, load
from pricestrata.session import shared_folder
from pricestrata.sources import evidence, tables
from pricestrata.streaming import holds, prices

load()
c = F.col
T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key."""
    rng = random.Random(7)
    rows = [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(40)}", T0 + timedelta(minutes=rng.randrange(40_000)), i, rng.randrange(100))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, i bigint, v int").cache()


def same(left, right):
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


@pytest.mark.parametrize("unit", ["HOUR", "DAY", "MONTH"])
def test_bucketed_windows_equal_plain_windows(skewed, unit):
    w = Window.partitionBy("k").orderBy("t", "i")
    bucket = ordered.time_bucket("t", unit)
    args = (["k"], ["t", "i"])
    maybe = F.when(c("v") > 60, c("v"))
    same(ordered.with_previous(skewed, *args, c("v"), bucket, "x"), skewed.withColumn("x", F.lag("v").over(w)))
    same(ordered.with_next(skewed, *args, c("v"), bucket, "x"), skewed.withColumn("x", F.lead("v").over(w)))
    same(
        ordered.carry_forward(skewed, *args, maybe, bucket, "x"),
        skewed.withColumn("x", F.last(maybe, ignorenulls=True).over(w)),
    )
    same(
        ordered.running(skewed, *args, c("v").cast("bigint"), bucket, "x"),
        skewed.withColumn("x", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))),
    )
    same(
        ordered.running(skewed, *args, c("v"), bucket, "x", how="max", inclusive=False),
        skewed.withColumn("x", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))),
    )


def test_overlap_counts_equal_pairs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        start = T0 + timedelta(days=rng.randrange(60))
        end = None if i % 17 == 0 else start + timedelta(days=rng.choice([0, 0, 1, 5, 40]))
        rows.append(("a" if i % 3 else "b", start, end))
    far = datetime(9999, 1, 1)
    want = {}
    for i, (k, s, e) in enumerate(rows):
        for k2, s2, e2 in rows[i + 1 :]:
            if k == k2 and s < (e2 or far) and s2 < (e or far):
                want[k] = want.get(k, 0) + 1
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz")
    got = lookups.overlap_counts(df, ["k"], "s", "e", F.date_trunc("MONTH", "__at"), F.lit(far).cast("timestamp_ntz"))
    assert {r["k"]: r["n"] for r in got.groupBy("k").agg(F.sum("overlaps").alias("n")).collect()} == want


def _points(spark):
    return bind.frame(spark, "/root/testdata/sf0.001", "points")


def test_append_twice_adds_nothing_and_order_does_not_matter(spark):
    rows = _points(spark).withColumn("payload_hash", c("source_hash"))
    path = shared_folder(spark, "facts")
    store = rows.limit(0)
    first = facts.new_facts(rows, store)
    tables.append_facts(first, path)
    stored = spark.read.schema(first.schema).parquet(path)
    assert stored.count() == rows.count()
    assert facts.new_facts(rows, stored).count() == 0
    columns = ["listing_id", "region_code", "observation_key"]
    same(
        facts.rebuild_current(rows).select(*columns),
        facts.rebuild_current(rows.orderBy(F.rand(5))).select(*columns),
    )


def test_revert_of_a_correction_adds_nothing(spark):
    rows = [(i, p, p) for i, p in enumerate(["A", "A", "B", "A", "B"])]
    df = spark.createDataFrame(rows, "ingest_seq bigint, payload_hash string, base_key string").select(
        "*", F.lit("L").alias("listing_id"), F.lit("R").alias("revision_id"), F.lit("CITY").alias("region_scope"),
        F.lit("1").alias("region_code"), F.lit(T0).cast("timestamp_ntz").alias("observed_at"), F.lit("h").alias("source_hash"),
    )
    got = {r["base_key"]: r["supersedes_key"] for r in facts.correction_chain(df).collect()}
    assert got == {"A": None, "B": "A"}


def test_evidence_files(spark, tmp_path):
    import gzip
    import hashlib

    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "ok.gz").write_bytes(gzip.compress("正文".encode()))
    (tmp_path / "src" / "torn.gz").write_bytes(b"not gzip")
    digest = hashlib.sha256("正文".encode()).hexdigest()
    want = [(1, "src/ok.gz", digest), (2, "src/torn.gz", digest), (3, "src/none.gz", digest), (4, "../x", digest), (5, "src/ok.gz", "0" * 64)]
    files = evidence.unpack(evidence.read_files(spark, f"file:{tmp_path}"))
    out = evidence.verify(files, spark.createDataFrame(want, "record_id int, relative_path string, digest string"))
    got = {r["record_id"]: r["fault"] for r in out.collect()}
    assert got == {1: None, 2: "BODY_UNREADABLE", 3: "FILE_MISSING", 4: "PATH_ESCAPES", 5: "HASH_MISMATCH"}


def brute_hold(rows, limit=Decimal("0.30")):
    """One listing: (seq, at, cents) in order -> verdicts; nothing times out."""
    last = held = None
    out = {}
    for seq, at, cents in rows:
        if last and at <= last[0]:
            out[seq] = "HISTORY"
        elif last and abs(cents - last[1]) > limit * last[1]:
            if held and held[2] == cents and at > held[1]:
                out[held[0]], out[seq] = "CONFIRMED", "TRUSTED"
                last, held = (at, cents), None
            else:
                if held:
                    out[held[0]] = "PRICE_CHANGE_UNCONFIRMED"
                held, out[seq] = (seq, at, cents), "HELD"
        else:
            if held:
                out[held[0]] = "PRICE_CHANGE_UNCONFIRMED"
                held = None
            out[seq] = "TRUSTED"
            last = (at, cents)
    return out


def test_stream_hold_equals_brute_force(spark, tmp_path):
    rng = random.Random(11)
    data, want = [], {}
    for listing in range(6):
        series = []
        for n in range(30):
            seq = listing * 100 + n
            price = rng.choice([1000, 1000, 1100, 2000, 2000, 700])
            at = T0 + timedelta(hours=n)
            series.append((seq, at, price))
            data.append((f"L{listing}", "NATIONAL", "CN", seq, at, Decimal(price) / 100, "ACCEPTED"))
        want.update(brute_hold(series))
    schema = "listing_id string, region_scope string, region_code string, ingest_seq bigint, observed_at timestamp_ntz, current_price decimal(18,2), quality_status string"
    df = spark.createDataFrame(data, schema)
    for part in range(2):
        half = df.where((c("ingest_seq") % 100 < 15) if part == 0 else (c("ingest_seq") % 100 >= 15))
        half.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = prices.events_stream(spark, str(tmp_path / "in"), "*.parquet", df.schema, 1)
    root = str(tmp_path / "held")
    holds.hold_changes(stream, root, wait_ms=10**12, slice_ms=3_600_000 * 4).awaitTermination()
    verdicts = holds.settled(holds.read_verdicts(spark, root))
    got = {r["ingest_seq"]: r["verdict"] for r in verdicts.collect()}
    assert got == want and len(got) == len(data)


def test_moves_of_slices_equal_the_chain():
    """Any cut into slices, any grouping of their moves, and any state before."""
    rng = random.Random(5)
    limit = holds.limit_of("0.30", 5)
    for _ in range(400):
        at, rows = 0, []
        for seq in range(rng.randrange(1, 40)):
            at += rng.choice([0, 1, 1, 2, 7_000])
            rows.append((at, rng.choice([100, 100, 129, 130, 131, 200, 200, 70, 5]), seq))
        state = holds.State()
        if rng.random() < 0.7:
            hold = (rng.choice([100, 200, 70]), rng.choice([-1, -9_000]), 99) if rng.random() < 0.5 else (None, None, None)
            state = holds.State(rng.choice([100, 130, 200, 5, 1_000]), -10_000, *hold)
        want, _ = holds.judge(state, rows, limit)
        cuts = sorted({r[0] for r in rows[1:] if rng.random() < 0.3})
        parts = [[r for r in rows if a <= r[0] < b] for a, b in zip([-1, *cuts], [*cuts, 10**9], strict=True)]
        moves = [holds.unpacked(holds.packed(holds.move_of(p, limit))) for p in parts if p]
        while len(moves) > 1:
            i = rng.randrange(len(moves) - 1)
            moves[i : i + 2] = [moves[i].then(moves[i + 1], limit)]
        assert moves[0].after(state, limit) == want


def test_stream_hold_of_one_hot_listing_over_late_batches(spark, tmp_path, monkeypatch):
    """One listing has nearly all rows; its slices are many, and the deliveries overlap in time."""
    monkeypatch.setattr(holds, "SECTION", 5)
    rng = random.Random(3)
    rows = [
        ("HOT" if n % 20 else f"L{n % 3}", "NATIONAL", "CN", n, T0 + timedelta(hours=n // 2),
         Decimal(rng.choice([1000, 1000, 1100, 2000, 2000, 700])) / 100, "ACCEPTED")
        for n in range(900)
    ]
    schema = "listing_id string, region_scope string, region_code string, ingest_seq bigint, observed_at timestamp_ntz, current_price decimal(18,2), quality_status string"
    parts = [[r for r in rows if 300 <= r[3] < 700], [r for r in rows if r[3] < 400], [r for r in rows if r[3] >= 600]]
    df = spark.createDataFrame(rows, schema)
    root = str(tmp_path / "held")
    for k, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
        stream = prices.events_stream(spark, str(tmp_path / "in/*"), "*.parquet", df.schema)
        holds.hold_changes(stream, root, slice_ms=3_600_000 * 7).awaitTermination()
    got = sorted(
        (r["batch_id"], r["listing_id"], r["ingest_seq"], r["verdict"])
        for r in spark.read.parquet(f"{root}/verdicts").collect()
    )
    want, states = [], {}
    limit = holds.limit_of("0.30", 86_400_000)
    for k, part in enumerate(parts):
        for listing in {r[0] for r in part}:
            own = [(int((r[4] - T0).total_seconds() * 1e6), int(r[5] * 100), r[3]) for r in part if r[0] == listing]
            states[listing], out = holds.judge(states.get(listing, holds.State()), sorted(own, key=lambda x: (x[0], x[2])), limit)
            want += [(k, listing, seq, verdict) for seq, verdict in out]
    assert got == sorted(want)


def test_stream_ingest_and_pointer_over_late_batches(spark, tmp_path):
    rows = _points(spark)
    early, late = rows.where("observed_date >= DATE '2024-01-15'"), rows.where("observed_date < DATE '2024-01-15'")
    for part in (early, late, early.limit(40)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = prices.events_stream(spark, str(tmp_path / "in"), "*.parquet", rows.schema, 1)
    prices.ingest(stream, str(tmp_path / "a")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "a/facts")).count() == rows.count()
    running = prices.follow_current(stream, str(tmp_path / "b"))
    running.awaitTermination()
    last, schema = running.lastProgress["batchId"], rows.select(*facts.POINTER).schema
    current = prices.current_pointers(spark, str(tmp_path / "b"), last, schema)
    accepted = rows.where("quality_status = 'ACCEPTED'")
    key = ["listing_id", "region_scope", "region_code"]
    newest = ordered.newest(accepted.select(*facts.POINTER), key, [c("observed_at"), c("ingest_seq")])
    same(current.select(*key, "observation_key"), newest.select(*key, "observation_key"))


def test_late_runs_are_reported(spark, tmp_path):
    for part in ([1, 4], [3], [4, 6]):
        rows = [("C", "P", n) for n in part]
        df = spark.createDataFrame(rows, "channel string, product_id string, run_no int")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = prices.events_stream(spark, str(tmp_path / "in"), "*.parquet", df.schema, 1)
    prices.write_stream(prices.count_misses(stream), str(tmp_path), "misses").awaitTermination()
    got = spark.read.schema(prices.MISS_OUTPUT).parquet(str(tmp_path / "misses")).collect()
    assert {(r["run_no"], r["misses_before"], r["late"]) for r in got} == {
        (1, None, False), (4, 2, False), (3, None, True), (6, 1, False),
    }


def test_pointer_moves_only_to_a_successor_of_its_time(spark):
    schema = (
        "listing_id string, region_scope string, region_code string, revision_id string, observation_key string, "
        "current_price int, availability string, observed_at timestamp_ntz, ingest_seq bigint, supersedes_key string"
    )

    def facts_of(*rows):
        made = [("L", "S", "R", rev, key, 1, "ON_SALE", T0 + timedelta(hours=h), seq, up) for key, rev, h, seq, up in rows]
        return spark.createDataFrame(made, schema)

    def tip(pointers, new, revisions=None):
        return facts.advance_current(pointers, new, revisions).first()["observation_key"]

    at = facts_of(("k1", "r1", 0, 1, None))
    assert tip(at, facts_of(("k2", "r1", 0, 2, None))) == "k1"
    assert tip(at, facts_of(("k2", "r1", 0, 2, "k1"), ("k3", "r1", 0, 3, "k2"), ("k4", "r1", 0, 4, "k1"))) == "k3"
    assert tip(at, facts_of(("k0", "r1", -1, 9, "k1"))) == "k1"
    assert tip(at, facts_of(("k5", "r1", 1, 5, None), ("k6", "r1", 1, 6, None))) == "k5"
    assert tip(at, at) == "k1"
    now = spark.createDataFrame([("L", "r1")], "listing_id string, revision_id string")
    assert tip(at, facts_of(("k7", "r0", 2, 7, None)), now) == "k1"


def test_append_reads_only_the_days_of_the_batch(spark, tmp_path):
    rows = _points(spark).withColumn("payload_hash", c("source_hash"))
    rows.write.partitionBy("observed_date").parquet(str(tmp_path / "store"))
    store = spark.read.parquet(str(tmp_path / "store"))
    batch = rows.where("observed_date = DATE '2024-01-09'")
    plan = facts.classify_append(batch, store)._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x and "stored" not in x and "observed_date#" in x.split("PartitionFilters")[1])
    assert "PartitionFilters: [" in scan and "observed_date#" in scan.split("PartitionFilters")[1].split("]")[0]
    assert facts.classify_append(batch, store).where("outcome <> 'REPEAT'").count() == 0


def test_carries_meet_null_keys(spark):
    rows = [(None, 1, 5), (None, 2, 6), (None, 11, 7), ("a", 3, 8), ("a", 12, 9)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    bucket = F.floor(c("t") / 10)
    for run, want in (
        (ordered.with_previous, {1: None, 2: 5, 11: 6, 3: None, 12: 8}),
        (ordered.with_next, {1: 6, 2: 7, 11: None, 3: 9, 12: None}),
        (ordered.running, {1: 5, 2: 11, 11: 18, 3: 8, 12: 17}),
        (ordered.carry_forward, {1: 5, 2: 6, 11: 7, 3: 8, 12: 9}),
    ):
        got = run(df, ["k"], ["t"], c("v"), bucket, "o")
        assert {r["t"]: r["o"] for r in got.collect()} == want, run


def test_links_resolve_dot_segments(spark):
    from urllib.parse import urljoin

    base = "https://h.cn/a/b/c.html?x=1"
    links = ["./d", "../d?y=../z", "../../e/", "../../../f", "d/./e/../g", "/p/./q/../r", "..", ".", "d", "?z=1", "/a.b/..c/d..", "d/.."]
    df = spark.createDataFrame([(x,) for x in links], "href string")
    from pricestrata.functions.urls import absolute

    got = {r["href"]: r["u"] for r in df.select("href", absolute(F.lit(base), c("href")).alias("u")).collect()}
    assert got == {x: urljoin(base, x) for x in links}


SF = "/root/testdata/sf0.001"
BREAK = {
    "current_pointer_mismatch": ("current", lambda d: d.withColumn("region_code", F.lit("ZZ"))),
    "missing_current_pointer": ("current", lambda d: d.limit(0)),
    "invalid_current_revision": ("listing", lambda d: d.withColumn("current_revision_id", F.lit(-1))),
    "observation_identity_mismatch": ("run", lambda d: d.withColumn("channel_id", F.lit(-5))),
    "revision_evidence_mismatch": ("revision", lambda d: d.withColumn("first_record_id", F.lit(-1))),
    "untraceable_accepted_observation": ("record", lambda d: d.withColumn("raw_path", F.lit(None).cast("string"))),
    "device_match_cardinality": ("match", lambda d: d.limit(0)),
    "invalid_official_scope": ("merchant", lambda d: d.withColumn("seller_type", F.lit("UNKNOWN"))),
    "invalid_batch_terminal_state": ("run", lambda d: d.withColumn("accepted_count", F.lit(0))),
    "invalid_observation_semantics": ("observation", lambda d: d.withColumn("currency", F.lit("USD"))),
    "device_standard_identity_mismatch": ("variant", lambda d: d.withColumn("base_unit", F.lit("KG"))),
    "invalid_artifact_reference": ("record", lambda d: d.withColumn("raw_path", F.lit("/abs"))),
}


@pytest.mark.parametrize("name", sorted(BREAK))
def test_audit_finds_an_injected_fault(spark, name):
    t = audits.store(spark, SF)
    table, change = BREAK[name]
    before = audit.CRITICAL[name](t).count()
    after = audit.CRITICAL[name]({**t, table: change(t[table])}).count()
    assert after > before


def test_plans_push_filters_and_prune_columns(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_quantity > 40").select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity" in plan and "l_comment" not in plan
    pointer = load()["current_price_projection"].run(spark, SF)
    assert "CartesianProduct" not in pointer._jdf.queryExecution().executedPlan().toString()


def test_late_deliveries_keep_their_partitions_and_their_order(spark, tmp_path):
    from pathlib import Path

    from pricestrata.queries import streams

    sf, root = tmp_path / "sf", tmp_path / "late"
    sf.mkdir()
    for path in Path("/root/testdata/sf0.001").iterdir():
        if path.name != "events.parquet":
            (sf / path.name).symlink_to(path)
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(4).write.parquet(f"{sf}/events.parquet")
    streams.deliver_late(spark, str(sf), str(root), lambda late: prices.ingest(late, str(root)))
    assert [len(list((root / "events" / str(k)).glob("*.parquet"))) for k in range(3)] == [4, 4, 4]
    days = spark.read.parquet(f"{root}/facts").groupBy("batch_id").agg(
        F.min(F.dayofmonth("observed_date")).alias("a"), F.max(F.dayofmonth("observed_date")).alias("b")
    ).collect()
    got = {r["batch_id"]: (r["a"], r["b"]) for r in days}
    assert sorted(got) == [0, 1, 2] and got[0][0] > 20 and got[1][1] <= 10 and 10 < got[2][0] <= got[2][1] <= 20
