"""Registered queries of the corpus operators: they run, and equal their SQL where there is one."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from pricestrata.llm import bpe
from pricestrata.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, name):
    got = REGISTRY[name].run(spark, SF).toPandas()
    assert len(got)
    sql = REGISTRY[name].sql
    if sql is None:
        return
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def rows(df):
        return sorted(
            repr([None if v is None or v != v else int(v) if isinstance(v, float) else v for v in r])
            for r in df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False)
        )

    assert rows(got) == rows(want)


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert 0 < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(last) == before
    own = bpe.Coder(__import__("public_tokenizers").path("word_bpe_49k.json"))
    assert all(own.decode(r["ids"]) == r["decoded"] for r in last[:50])
    assert {r["doc_id"] for r in last} == {r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()}
