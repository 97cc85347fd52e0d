"""Missing products by timers, against a plain rewrite of the rule."""

from __future__ import annotations

import random

from pricestrata.streaming import misses

SCHEMA = "channel string, product_id string, run_no int, run_at timestamp, due_at timestamp"
LAST = 25


def _sighting(product, run):
    due = f"2024-01-{run + 2:02d}" if run + 2 <= LAST else None
    return ("c", product, run, f"2024-01-{run:02d}", due)


def _deliver(spark, root, parts):
    for k, rows in enumerate(parts):
        written = spark.createDataFrame(
            rows, "channel string, product_id string, run_no int, run_at string, due_at string"
        ).selectExpr(
            "channel", "product_id", "run_no", "CAST(run_at AS timestamp) run_at", "CAST(due_at AS timestamp) due_at"
        )
        written.write.parquet(f"{root}/in/{k}")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in/*")
        misses.start(misses.track(stream, "5 days"), root).awaitTermination()
    return {tuple(r)[1:] for r in misses.outcomes(spark, root).collect()}


def test_products_are_missed_by_timers_in_any_order_of_delivery(spark, tmp_path):
    rng = random.Random(3)
    seen = {p: sorted(rng.sample(range(1, LAST + 1), rng.randint(1, 12))) for p in ("a", "b", "d", "e")}
    seen["hot"] = list(range(1, LAST + 1))
    parts = [[], [], [("c", None, None, "2024-02-20", None)]]
    for product, runs in seen.items():
        for run in runs:
            for _ in range(400 if product == "hot" and run % 5 == 0 else 1):
                late = rng.randint(0, 4)
                parts[min(2, (run + late) // 10)].append(_sighting(product, run))
    for part in parts:
        rng.shuffle(part)
    wanted = set()
    for product, runs in seen.items():
        for before, run, after in zip([None, *runs], runs, [*runs[1:], None]):
            wanted.add((product, run, "SEEN", None if before is None else run - before - 1))
            if (LAST + 1 if after is None else after) - run - 1 >= 2:
                wanted.add((product, run, "MISSING", 2))
    assert _deliver(spark, str(tmp_path), parts) == wanted
    assert any(o == "MISSING" and r == seen[p][-1] for p, r, o, _ in wanted), "a product that nobody sees again"


def test_a_sighting_that_contradicts_a_report_is_late(spark, tmp_path):
    clock = [("c", None, None, "2024-01-15", None)]
    got = _deliver(spark, str(tmp_path), [
        [_sighting("a", 1), _sighting("a", 2), *clock],
        [_sighting("a", 3), _sighting("a", 2), _sighting("a", 8)],
        [("c", None, None, "2024-02-20", None)],
    ])
    assert got == {
        ("a", 1, "SEEN", None), ("a", 2, "SEEN", 0), ("a", 2, "MISSING", 2), ("a", 3, "LATE", None),
        ("a", 8, "SEEN", 5), ("a", 8, "MISSING", 2),
    }


def test_no_sightings_give_no_outcomes(spark, tmp_path):
    assert _deliver(spark, str(tmp_path), [[("c", None, None, "2024-01-15", None)]]) == set()
