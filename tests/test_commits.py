"""Atomic commits of several tables, and facts laid out for a join without an exchange."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pricestrata.functions.identity import PAYLOAD_FIELDS
from pricestrata.plans import commits, replay


def test_a_run_that_dies_between_tables_leaves_nothing_and_can_run_again(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.range(20).select("id", F.lit("2024-01-01").cast("date").alias("observed_date"))
    broken = rows.withColumn("x", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        commits.commit(spark, root, "one", {"observation": rows, "listing": broken})
    assert commits.entries(spark, root) == [] and commits.read(spark, root, "observation") is None
    assert commits.commit(spark, root, "one", {"observation": rows, "listing": rows})
    assert not commits.commit(spark, root, "one", {"observation": rows, "listing": rows})
    assert not commits._append(spark, root, {"number": 0, "batch": "other", "tables": {}})
    assert commits.commit(spark, root, "two", {"observation": rows.where("id < 5")})
    assert commits.read(spark, root, "observation").groupBy("commit_no").count().sort("commit_no").collect() == [
        (0, 20), (1, 5)
    ]
    assert commits.read(spark, root, "listing").count() == 20
    assert [e["batch"] for e in commits.entries(spark, root)] == ["one", "two"]


def test_laid_out_facts_meet_without_an_exchange(spark):
    facts = spark.range(300).select(
        F.lit("2024-01-01").cast("date").alias("observed_date"), F.sha2(F.col("id").cast("string"), 256).alias("observation_key"),
        F.col("id").alias("record_id"), *[F.col("id").cast("string").alias(n) for n in PAYLOAD_FIELDS],
    )
    new, old = (replay.lay_out(f, "laid", 4) for f in (facts.where("record_id > 9"), facts.where("record_id < 290")))
    compared = replay.compare_facts(spark.table(new), spark.table(old))
    assert "Exchange" not in compared._jdf.queryExecution().executedPlan().toString()
    assert {r["verdict"]: r["count"] for r in compared.groupBy("verdict").count().collect()} == {
        "ONLY_REPLAYED": 10, "ONLY_STORED": 10, "MATCH": 280
    }
