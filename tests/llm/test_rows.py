"""Results do not depend on how Spark cuts a scan, which follows the cores that it has at the time."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from pricestrata.llm import nearcopies, repeats, spans, texts

SF = "/root/testdata/sf0.001"


@pytest.fixture
def cut(spark, monkeypatch, tmp_path):
    """Documents in many files, and a session whose scans are cut in another way after every written step."""
    path = str(tmp_path / "in many files")
    spark.read.parquet(f"{SF}/documents.parquet").repartition(12).write.parquet(path)
    name, real, n = "spark.sql.files.minPartitionNum", texts.stored, [0]

    def stored(df, purpose):
        out = real(df, purpose)
        n[0] += 1
        spark.conf.set(name, 1 + 3 * n[0] % 11)
        return out

    yield spark.read.parquet(path), lambda: monkeypatch.setattr(texts, "stored", stored)
    spark.conf.unset(name)


def rows(df):
    return Counter(map(repr, df.collect()))


def test_row_numbers_are_places_in_files(spark, cut):
    docs, change = cut
    first = texts.with_row_id(docs)
    want = {r["_rid"]: r["text"] for r in first.collect()}
    assert len(want) == docs.count()
    spark.conf.set("spark.sql.files.minPartitionNum", 12)
    some = texts.with_row_id(docs.where("doc_id % 3 = 1").select("text"), "n").collect()
    assert some and all(want[r["n"]] == r["text"] for r in some)


@pytest.mark.parametrize("operator", ["op5", "op6", "op7"])
def test_operators(spark, cut, monkeypatch, operator):
    docs, change = cut
    monkeypatch.setattr(spans, "BLOCK_WORDS", 300)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    run = {
        "op5": lambda: repeats.dedup(docs, 200), "op6": lambda: spans.decontaminate(docs, items),
        "op7": lambda: nearcopies.near_copies(docs),
    }[operator]
    want = rows(run())
    change()
    assert rows(run()) == want


def test_pipeline(spark, cut):
    docs, change = cut
    results = []
    for _ in range(2):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[1:4]:
            kept = texts.stored(stage(spark, kept, SF), name)
        results.append(rows(kept))
        change()
    assert results[0] == results[1]
