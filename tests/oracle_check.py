"""Run registered queries on both engines and compare: python tests/oracle_check.py [names]."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricestrata.queries import load  # noqa: E402
from pricestrata.session import TABLES, build  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return f"{type(value).__name__}:{value}"


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, str, list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    texts = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(rows), hashlib.sha256("\n".join(texts).encode()).hexdigest(), texts


def compare(spark, con, sf_dir: str, q) -> tuple[bool | None, str]:
    started = time.time()
    df = q.run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - started
    left = digest(df.columns, rows)
    if q.sql is None:
        return None, f"rows={left[0]} {took:.1f}s"
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    right = digest(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    note = f"rows={left[0]}/{right[0]} {took:.1f}s"
    if left[:2] == right[:2]:
        return True, note
    a, b = Counter(left[2]), Counter(right[2])
    return False, (
        note
        + "\n   spark only: " + "\n     ".join(list((a - b))[:3])
        + "\n   sql only:   " + "\n     ".join(list((b - a))[:3])
        + f"\n   columns: {sorted(names)}"
    )


def main() -> None:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark, con = build(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, q in load().items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            ok, note = compare(spark, con, sf_dir, q)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += ok is False
        print({True: "ok  ", False: "FAIL", None: "rows"}[ok], name, note, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
