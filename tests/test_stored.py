"""Stored files against references, and tables by their declared schemas."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from pricestrata.checks import audit, stored
from pricestrata.schemas import schema
from pricestrata.sources import inventory, tables
from pricestrata.sources.evidence import read_files


def _sha(body: bytes) -> str:
    return hashlib.sha256(body).hexdigest()


def test_only_asked_bodies_are_read_and_every_fault_has_a_name(spark, tmp_path):
    body = b"price " * 400_000
    for name, packed in {
        "a": gzip.compress(body), "b": gzip.compress(body)[:-3], "c": b"", "d/e": gzip.compress(b"x") + gzip.compress(b"y"),
        "f": b"no gzip", "g": gzip.compress(b"z"),
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(packed)
    rows = [
        (1, "a", _sha(body), len(body), True), (2, "a", _sha(body), None, False), (3, "b", _sha(body), None, True),
        (4, "c", _sha(b""), 0, True), (5, "d/e", _sha(b"xy"), 2, True), (6, "f", _sha(b"other"), None, False),
        (7, "gone", _sha(b""), None, True), (8, "../a", _sha(b""), None, True), (9, "g", "0" * 64, None, True),
        (10, "h", None, None, True), (None, None, None, None, None),
    ]
    schema = "record_id bigint, relative_path string, digest string, size bigint, asked boolean"
    references = spark.createDataFrame(rows, schema)
    faults = stored.file_faults(references, str(tmp_path))
    got = {r["relative_path"]: (r["n_records"], r["stored"], r["body_hash"], r["fault"]) for r in faults.collect()}
    assert got == {
        "a": (2, True, _sha(body), None), "b": (1, True, None, "BODY_UNREADABLE"), "c": (1, True, None, "FILE_EMPTY"),
        "d/e": (1, True, _sha(b"xy"), None), "f": (1, True, None, None), "gone": (1, False, None, "FILE_MISSING"),
        "../a": (1, False, None, "PATH_ESCAPES"), "g": (1, True, _sha(b"z"), "HASH_MISMATCH"),
        "h": (1, False, None, "HASH_MALFORMED"),
    }
    bad = stored.records_with_file_faults(references, faults)
    assert {r[0] for r in bad.collect()} == {3, 4, 7, 8, 9, 10}
    plan = inventory.inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_references_of_an_audit_and_an_absent_folder(spark, tmp_path):
    record = spark.createDataFrame(
        [(1, "a", "0" * 64, [("b", "1" * 64), (None, "2" * 64)]), (2, None, None, [])],
        "record_id bigint, raw_path string, raw_hash string, artifact_manifest array<struct<relative_path:string,source_hash:string>>",
    )
    references = audit.stored_references({"record": record})
    faults = stored.file_faults(references, str(tmp_path / "none"))
    assert {tuple(r)[0::4] for r in faults.collect()} == {("a", "FILE_MISSING"), ("b", "FILE_MISSING")}
    assert [r[0] for r in stored.records_with_file_faults(references, faults).collect()] == [1]


def test_tables_are_written_and_read_as_declared(spark, tmp_path):
    rows = spark.sql("SELECT 7 AS listing_id, 'NATIONAL' AS region_scope, 3 AS ingest_seq, DATE'2024-01-02' AS observed_at")
    for _ in range(2):
        tables.write_table(rows, str(tmp_path), "current")
    got = tables.read_table(spark, str(tmp_path), "current")
    assert got.schema == schema("current") and got.count() == 1
    row = got.first()
    assert (row["listing_id"], row["region_code"], row["ingest_seq"], row["observed_at"].day) == ("7", None, 3, 2)
    with pytest.raises(ValueError, match="declares no column price"):
        tables.write_table(rows.withColumnRenamed("region_scope", "price"), str(tmp_path), "current")


def test_folders_are_listed_by_tasks_and_digests_are_dealt(spark, tmp_path):
    """The driver listed all files, its scan took 32 files a task, and the bodies of a small table were read by one task."""
    for name, body in {
        "a": b"x", "d/b": b"xy", "d/e/c d": b"z", "d/empty": b"", "_hidden": b"x", ".part/x": b"x", "_k=1/f": b"xyz", "g._COPYING_": b"x",
    }.items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(body)
    for folder in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        held = inventory.inventory(spark, folder)
        assert {tuple(r) for r in held.collect()} == {("a", 1), ("d/b", 2), ("d/e/c d", 1), ("_k=1/f", 3)}
        assert {tuple(r) for r in held.collect()} == {tuple(r) for r in read_files(spark, folder, "length").collect()}
    assert "binaryFile" not in held._jdf.queryExecution().executedPlan().toString()
    one = spark.createDataFrame([("a",)], "relative_path string").coalesce(1)
    assert inventory.digests(one, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_contents_are_listed_and_read_by_tasks(spark, tmp_path):
    """The file source listed all files in the driver before their contents were read."""
    files = {"a": b"x", "d/b": b"xy" * 9, "d/e/c d": b"z", "_hidden": b"x", "d/empty": b""}
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True, parents=True)
        (tmp_path / name).write_bytes(body)
    for folder in (str(tmp_path), f"file:{tmp_path}"):
        held = read_files(spark, folder)
        assert {r.relative_path: bytes(r.content) for r in held.collect()} == {n: files[n] for n in ("a", "d/b", "d/e/c d")}
        assert "binaryFile" not in held._jdf.queryExecution().executedPlan().toString()
