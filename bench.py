"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricestrata.queries import load  # noqa: E402
from pricestrata.session import build  # noqa: E402

HEADLINE = (
    "price_gate", "observation_keys", "current_price_projection", "append_outcomes",
    "correction_chain", "large_changes", "as_of_prices", "overlapping_intervals", "unit_status",
    "miss_streaks", "money_amounts", "quantity_parse", "fresh_identity_rules",
    "device_identity_rule", "normalized_text", "market_groups", "sheet_prices", "page_links",
    "record_run_channel", "star_with_optional_brand", "audit_current_pointer_mismatch",
    "audit_outdated_current_revision", "audit_overlapping_accepted_matches", "replayed_facts",
    "fact_write_faults", "stream_current",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(f"local[{cpus}]", "bench", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    names = sys.argv[1:] or HEADLINE
    # One small query first, so that no entry pays for starting the JVM and the Python workers.
    registry["normalized_text"].run(spark, sf_dir).limit(1).write.format("noop").mode(
        "overwrite"
    ).save()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
