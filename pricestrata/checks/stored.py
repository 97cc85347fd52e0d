"""References of records against the files that are stored, both ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.session import shared_folder
from pricestrata.sources import evidence, inventory

c = F.col


def per_path(references: DataFrame) -> DataFrame:
    """One row per path that records name: how many, whether they agree, and whether a body is to be read.

    ``references`` holds record_id, relative_path, digest, size (null: not stated) and asked.
    """
    digest = c("digest")
    return references.groupBy("relative_path").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("digest").alias("digest"),
        (
            (F.min(digest) != F.max(digest)) | (F.coalesce(F.min("size") != F.max("size"), F.lit(False)))
        ).alias("disagree"),
        F.bool_or(~F.coalesce(digest.rlike(r"^[0-9a-f]{64}\z"), F.lit(False))).alias("malformed"),
        F.min("size").alias("wanted_size"),
        F.coalesce(F.bool_or("asked"), F.lit(False)).alias("asked"),
    )


def _fault() -> Column:
    """The first thing wrong with a path; what needs the body is known only where it was read."""
    return F.coalesce(
        F.when(c("n_records").isNull(), "FILE_EXTRA"),
        evidence.path_fault(c("relative_path")),
        F.when(c("malformed"), "HASH_MALFORMED"),
        F.when(c("disagree"), "REFERENCES_DISAGREE"),
    )


def file_faults(references: DataFrame, folder: str) -> DataFrame:
    """relative_path, n_records, stored, body_hash (null: not read) and fault of every path that is named or stored.

    References are reduced to one row per path before they meet the inventory, so a file that very many records name is
    one row of the join. Bodies are read only where a record asks for it and nothing is wrong before. The scan shows no empty
    files, so a path it lacks is opened too, which tells an empty file from one that is not there; an empty file that
    no record names stays unseen.
    """
    spark = references.sparkSession
    named = per_path(references).where(c("relative_path").isNotNull())
    held = inventory.inventory(spark, folder)
    met = named.join(held, "relative_path", "full").withColumn("fault", _fault())
    # Written once: the second half reads files by what the first half found.
    work = shared_folder(spark, "inventory")
    met.write.parquet(work)
    met = spark.read.schema(met.schema).parquet(work)
    unseen = c("length").isNull() & evidence.path_fault(c("relative_path")).isNull()
    bodies = inventory.digests(met.where((c("asked") & c("fault").isNull()) | unseen), folder)
    late = F.coalesce(
        c("fault"),
        c("error"),
        F.when(c("body_hash") != c("digest"), "HASH_MISMATCH"),
        F.when(c("size") != c("wanted_size"), "SIZE_MISMATCH"),
    )
    return met.join(bodies, "relative_path", "left").select(
        "relative_path", F.coalesce("n_records", F.lit(0).cast("bigint")).alias("n_records"),
        (c("length").isNotNull() | F.coalesce(c("error") == "FILE_EMPTY", F.lit(False))).alias("stored"), "body_hash", late.alias("fault"),
    )


def records_with_file_faults(references: DataFrame, faults: DataFrame) -> DataFrame:
    """Records that name a path with a fault."""
    bad = faults.where(c("fault").isNotNull() & (c("n_records") > 0)).select("relative_path")
    return references.join(bad, "relative_path", "left_semi").select("record_id").distinct()
