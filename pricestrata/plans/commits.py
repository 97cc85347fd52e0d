"""All tables of a batch in one atomic commit.

A batch first stages a part of every table, each in a folder of its own attempt; nobody reads these. Then one small
file in the log names all parts, and readers follow the log alone: a batch is there with all its tables or not at all. An
entry takes the next free number by a rename that does not replace, so that two writers cannot share a number.
A batch id is committed once: another run of it changes nothing, and parts that a dead
run left are never named.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pricestrata.operators import facts as fact_ops
from pricestrata.operators.ordered import newest
from pricestrata.plans import batch as plan
from pricestrata.session import path_exists

c = F.col
#: Tables whose parts are ranges of days, sorted, so that a filter on days skips files and row groups. A batch may
#: touch thousands of days, so days are no folders.
DATED = ("observation",)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def entries(spark: SparkSession, root: str) -> list[dict]:
    """The committed batches in order: a small entry each."""
    log = f"{root}/_log"
    if not path_exists(spark, log):
        return []
    rows = spark.read.schema("number bigint, batch string, tables map<string,struct<path:string,schema:string>>")
    found = rows.option("pathGlobFilter", "[0-9]*.json").json(log).collect()
    return sorted((r.asDict(recursive=True) for r in found), key=lambda e: e["number"])


def _append(spark: SparkSession, root: str, entry: dict) -> bool:
    """Write a log entry under its number; False if that number is taken."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    draft, files = _files(spark, f"{root}/_log/.{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_log/{entry['number']:012d}.json")
    out = files.create(draft)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    none = spark.sparkContext._gateway.new_array(rename, 1)
    none[0] = rename.valueOf("NONE")
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), none)
    except Exception as taken:  # py4j gives every Java error the same type
        if "FileAlreadyExists" not in str(taken):
            raise
        return False
    return True


def commit(spark: SparkSession, root: str, batch_id: str, tables: dict[str, DataFrame]) -> bool:
    """Stage all tables and commit them under ``batch_id``; False if it was committed before."""
    if any(e["batch"] == batch_id for e in entries(spark, root)):
        return False
    attempt, staged = uuid.uuid4().hex, {}
    for name, rows in tables.items():
        path = f"{name}/batch={batch_id}/attempt={attempt}"
        if name in DATED:
            rows = rows.repartitionByRange("observed_date").sortWithinPartitions("observed_date")
        rows.write.parquet(f"{root}/{path}")
        staged[name] = {"path": path, "schema": rows.schema.json()}
    while True:
        known = entries(spark, root)
        if any(e["batch"] == batch_id for e in known):
            return False
        number = known[-1]["number"] + 1 if known else 0
        if _append(spark, root, {"number": number, "batch": batch_id, "tables": staged}):
            return True


def read(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """All committed rows of a table with their ``commit_no``; None before the first commit."""
    parts = [(e["number"], e["tables"][name]) for e in entries(spark, root) if name in e["tables"]]
    if not parts:
        return None
    schema = StructType.fromJson(json.loads(parts[-1][1]["schema"])).add("batch", "string").add("attempt", "string")
    rows = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*[f"{root}/{p['path']}" for _, p in parts])
    numbers = spark.createDataFrame([(p["path"].split("=")[-1], n) for n, p in parts], "attempt string, commit_no bigint")
    # One row per commit.
    return rows.join(F.broadcast(numbers), "attempt").drop("attempt", "batch")


# --- the tables of a price batch


def linked_facts(judged: DataFrame, adapter: str, stored: DataFrame | None) -> DataFrame:
    """Facts of a batch that the store does not have, linked to what it holds at their instants."""
    trusted = judged.where(c("identity_status") == "ACCEPTED")
    keyed = fact_ops.with_keys(trusted, adapter).withColumns({
        "base_key": c("observation_key"), "base_payload": c("payload_hash")
    })
    key = ["observed_date", "base_key"]
    first = plan.settle(fact_ops.first_arrivals(keyed, key), "arrivals")
    none = F.lit(None).cast("string")
    if stored is not None:
        # The batch's span of days as literals, which the scan of the store skips by.
        low, high = first.agg(F.min("observed_date"), F.max("observed_date")).first()
        stored = stored.where(c("observed_date").between(low, high)).drop("commit_no")
        first = first.join(stored.select(*key), key, "left_anti")
    accepted = first.where(c("quality_status") == "ACCEPTED").withColumn("_new", F.lit(True))
    if stored is not None:
        old = stored.where(c("quality_status") == "ACCEPTED").withColumn("payload_hash", c("base_payload"))
        names = [n for n in accepted.columns if n != "_new"]
        accepted = accepted.unionByName(old.select(*names).withColumn("_new", F.lit(False)))
    chain = fact_ops.correction_chain(accepted).where("_new").drop("_new")
    others = first.where(c("quality_status") != "ACCEPTED").withColumn("supersedes_key", none)
    return fact_ops.with_keys(chain.unionByName(others), adapter, c("supersedes_key"))


def apply_batch(spark: SparkSession, root: str, batch_id: str, judged: DataFrame, adapter: str) -> bool:
    """Merge a judged batch into all stored tables, in one commit.

    Facts are appended by key. Merchants, listings and revisions are appended as the batch saw them and
    merged on reading. A pointer is written where the batch moves it; the newest commit holds.
    """
    if any(e["batch"] == batch_id for e in entries(spark, root)):
        return False
    derived = plan.outputs(judged, adapter)
    facts = plan.settle(linked_facts(judged, adapter, read(spark, root, "observation")), "facts")
    accepted = facts.where(c("quality_status") == "ACCEPTED")
    pointers = current(spark, root)
    names = [*fact_ops.POINTER, "base_key"]
    if pointers is None:
        pointers = spark.createDataFrame([], accepted.select(*names).schema)
    touched = pointers.join(accepted.select(*fact_ops.REGION).distinct(), fact_ops.REGION, "left_semi")
    moved = fact_ops.advance_current(touched, accepted)
    return commit(spark, root, batch_id, {
        "merchant": derived["merchant"], "listing": derived["listing"], "revision": derived["revision"],
        "observation": facts, "current": moved.select(*names), "review": derived["review"], "rejected": derived["rejected"],
    })


def current(spark: SparkSession, root: str) -> DataFrame | None:
    rows = read(spark, root, "current")
    return None if rows is None else newest(rows, fact_ops.REGION, [c("commit_no")]).drop("commit_no")


def seen(spark: SparkSession, root: str, name: str, key: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Merchants or listings over all commits: the first and the last sighting, and the newest of ``extra``."""
    rows = read(spark, root, name)
    more = [F.max_by(x, "last_seen_at").alias(n) for n, x in (extra or {}).items()]
    return rows.groupBy(*key).agg(
        F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), *more
    )
