"""Price facts: keys, idempotent append, revisions, corrections, match intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.functions.identity import PAYLOAD_FIELDS, observation_key, payload_hash
from pricestrata.operators.ordered import newest, running, with_next, with_previous

REGION = ["listing_id", "region_scope", "region_code"]


def with_keys(df: DataFrame, adapter_version: str, supersedes: Column | None = None) -> DataFrame:
    """Payload hash, observation key and storage date of every gated candidate."""
    return df.withColumns(
        {
            "payload_hash": payload_hash(supersedes),
            "observation_key": observation_key(
                F.lit(adapter_version), F.col("policy_version"), supersedes
            ),
            "observed_date": F.col("observed_at").cast("date"),
        }
    )


def first_arrivals(batch: DataFrame, key: list[str]) -> DataFrame:
    """Earliest arrival per key, reduced before the shuffle."""
    names = [c for c in batch.columns if c not in key]
    return (
        batch.groupBy(*key)
        .agg(F.min_by(F.struct(*names), F.col("ingest_seq")).alias("first"))
        .select(*key, *[F.col("first")[n].alias(n) for n in names])
        .select(*batch.columns)
    )


def days_of(batch: DataFrame, column: str = "observed_date") -> list:
    """The distinct storage days of a batch: as few as the days it covers."""
    rows = batch.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(r[0] for r in rows)


def on_days(store: DataFrame, days: list, column: str = "observed_date") -> DataFrame:
    """The store on given days, as a literal filter that prunes partitions at the scan."""
    return store.where(F.col(column).isin(days)) if days else store.where(F.lit(False))


def classify_append(batch: DataFrame, store: DataFrame, days: list | None = None) -> DataFrame:
    """One row per distinct key of the batch with its outcome INSERT, REPEAT or CONFLICT.

    Only the days of the batch are read from the store. They are taken from the batch, which
    should be a written table; a caller that knows them gives ``days``.
    """
    store = on_days(store, days_of(batch) if days is None else days)
    key = ["observed_date", "observation_key"]
    names = [c for c in batch.columns if c not in key]
    arrivals = batch.groupBy(*key).agg(
        F.min_by(F.struct(*names), F.col("ingest_seq")).alias("first"),
        F.count(F.lit(1)).alias("deliveries"),
        (F.min("payload_hash") != F.max("payload_hash")).alias("torn"),
    )
    known = store.select(*key, F.col("payload_hash").alias("stored_payload"))
    outcome = (
        F.when(
            F.col("torn") | (F.col("stored_payload") != F.col("first.payload_hash")),
            "CONFLICT",
        )
        .when(F.col("stored_payload").isNotNull(), "REPEAT")
        .otherwise("INSERT")
    )
    return arrivals.join(known, key, "left").select(
        *key,
        *[F.col("first")[n].alias(n) for n in names],
        "deliveries",
        outcome.alias("outcome"),
    )


def new_facts(batch: DataFrame, store: DataFrame, days: list | None = None) -> DataFrame:
    return (
        classify_append(batch, store, days)
        .where(F.col("outcome") == "INSERT")
        .drop("outcome", "deliveries")
    )


def revision_numbers(rows: DataFrame) -> DataFrame:
    """Distinct fingerprints per listing, numbered by first appearance, with their time range."""
    seen = rows.groupBy("listing_id", "identity_fingerprint").agg(
        F.min(F.struct("observed_at", "ingest_seq")).alias("first"),
        F.min("observed_at").alias("first_observed_at"),
        F.max("observed_at").alias("last_observed_at"),
    )
    order = Window.partitionBy("listing_id").orderBy("first.ingest_seq")
    return seen.withColumn("first_seq", F.col("first.ingest_seq")).select(
        "listing_id",
        "identity_fingerprint",
        F.row_number().over(order).alias("revision_no"),
        "first_observed_at",
        "last_observed_at",
    )


def current_revision(facts: DataFrame) -> DataFrame:
    """Revision with the newest trusted price per listing; equal times are a conflict."""
    newest_time = (
        facts.where(F.col("quality_status") == "ACCEPTED")
        .groupBy("listing_id", "revision_id")
        .agg(F.max("observed_at").alias("trusted_at"))
    )
    rank = Window.partitionBy("listing_id").orderBy(F.col("trusted_at").desc())
    return (
        newest_time.withColumn("r", F.rank().over(rank))
        .where("r = 1")
        .groupBy("listing_id")
        .agg(
            F.min("revision_id").alias("revision_id"),
            F.max("trusted_at").alias("trusted_at"),
            (F.count(F.lit(1)) > 1).alias("conflict"),
        )
    )


def uncorrected(facts: DataFrame) -> DataFrame:
    """Accepted facts that no later fact corrects; a correction shares its date with its target."""
    accepted = facts.where(F.col("quality_status") == "ACCEPTED")
    if "supersedes_key" not in facts.columns:
        return accepted
    corrected = accepted.where(F.col("supersedes_key").isNotNull()).select(
        F.col("supersedes_key").alias("base_key"), "observed_date"
    )
    return accepted.join(corrected, ["observed_date", "base_key"], "left_anti")


POINTER = [
    *REGION, "revision_id", "observation_key", "current_price", "availability", "observed_at",
    "ingest_seq",
]


def rebuild_current(facts: DataFrame) -> DataFrame:
    """Latest-price pointer per listing and region, rebuilt from the facts alone.

    One pass: facts shrink to one row per (listing, region, revision) before the shuffle, and
    the current revision is picked from those rows. A listing whose newest trusted time is
    shared by two revisions has no current revision.
    """
    best = newest(
        uncorrected(facts).select(*POINTER),
        [*REGION, "revision_id"],
        [F.col("observed_at"), F.col("ingest_seq")],
    )
    listing = Window.partitionBy("listing_id")
    at_top = F.when(F.col("observed_at") == F.col("top"), F.col("revision_id"))
    return (
        best.withColumn("top", F.max("observed_at").over(listing))
        .withColumns({"low": F.min(at_top).over(listing), "high": F.max(at_top).over(listing)})
        .where((F.col("low") == F.col("high")) & (F.col("revision_id") == F.col("low")))
        .select(*POINTER)
    )


def _links(df: DataFrame) -> DataFrame:
    """Pointer columns with the key a fact is linked by and the key it supersedes."""
    base = F.col("base_key") if "base_key" in df.columns else F.col("observation_key")
    link = F.col("supersedes_key") if "supersedes_key" in df.columns else F.lit(None)
    return df.select(*POINTER, base.alias("_base"), link.cast("string").alias("_supersedes"))


def advance_current(
    pointers: DataFrame, accepted: DataFrame, revisions: DataFrame | None = None
) -> DataFrame:
    """Move pointers with newly accepted facts.

    A pointer moves to a later fact, or to one of its own time that supersedes the fact it is
    on; any other fact of the same time, and every earlier one, leaves it. Without a pointer
    the first arrival of the latest time opens it. Facts that have a ``base_key`` are linked by it,
    and the pointers keep it. With ``revisions`` (listing_id, revision_id)
    only facts of the current revision count.

    Facts are grouped per instant first, then the latest instant of each region is taken: what is
    gathered is one instant of one listing and region, as long as its chain of corrections.
    """
    if revisions is not None:
        accepted = accepted.join(revisions, ["listing_id", "revision_id"], "left_semi")
    rows = (
        _links(pointers).withColumn("_new", F.lit(0))
        .unionByName(_links(accepted).withColumn("_new", F.lit(1)))
        # The pointer's own fact may come again; it is no successor of itself.
        .dropDuplicates([*REGION, "observed_at", "_new", "_base", "ingest_seq"])
    )
    rest = [x for x in POINTER if x not in [*REGION, "observed_at"]]
    fact = F.struct("_new", "ingest_seq", "_base", "_supersedes", F.struct(*rest).alias("row"))
    instants = rows.groupBy(*REGION, "observed_at").agg(
        F.array_sort(F.collect_list(fact)).alias("facts")
    )
    latest = instants.groupBy(*REGION).agg(
        F.max("observed_at").alias("observed_at"), F.max_by("facts", "observed_at").alias("facts")
    )
    tip = F.aggregate(
        F.slice("facts", 2, F.size("facts")),
        F.element_at("facts", 1),
        lambda at, x: F.when(x["_supersedes"] == at["_base"], x).otherwise(at),
    )
    linked = [F.col("tip._base").alias("base_key")] if "base_key" in accepted.columns else []
    return latest.withColumn("tip", tip).select(
        *[F.col(x) if x in [*REGION, "observed_at"] else F.col("tip.row")[x].alias(x) for x in POINTER],
        *linked,
    )


def switch_revisions(pointers: DataFrame, facts: DataFrame) -> DataFrame:
    """Drop pointers of listings whose current revision changed and rebuild those only."""
    now = current_revision(facts).where(~F.col("conflict")).select("listing_id", "revision_id")
    kept = pointers.join(now, ["listing_id", "revision_id"], "left_semi")
    switched = (
        pointers.join(now, ["listing_id", "revision_id"], "left_anti")
        .select("listing_id")
        .distinct()
    )
    rebuilt = rebuild_current(facts.join(switched, "listing_id", "left_semi"))
    return kept.unionByName(rebuilt.select(*kept.columns))


def same_time_conflicts(facts: DataFrame) -> DataFrame:
    """Instants at which one listing and region has more than one accepted key."""
    return (
        facts.where(F.col("quality_status") == "ACCEPTED")
        .groupBy(*REGION, "observed_at", "observation_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*REGION, "observed_at")
        .agg(F.count(F.lit(1)).alias("distinct_keys"), F.sum("n").alias("facts"))
        .where(F.col("distinct_keys") > 1)
    )


def correction_chain(facts: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """Link same-time publications: each distinct payload corrects the one before it.

    An exact repeat of any earlier payload collapses into it, so a revert adds nothing.
    """
    group = ["listing_id", "revision_id", "region_scope", "region_code", "observed_at"]
    distinct = first_arrivals(facts, [*group, "source_hash", "payload_hash"])
    return with_previous(
        distinct,
        group,
        ["ingest_seq"],
        F.col("base_key"),
        F.floor(F.col("ingest_seq") / chunk),
        "supersedes_key",
    )


def match_intervals(matches: DataFrame, chunk: int = 1_000_000) -> DataFrame:
    """Close accepted matches in arrival order; a match that moves back in time is an error."""
    key = ["revision_id", "variant_id", "matcher_version"]
    firsts = first_arrivals(matches, key)
    bucket = F.floor(F.col("ingest_seq") / chunk)
    judged = running(
        firsts, ["revision_id"], ["ingest_seq"], F.col("effective_from"), bucket, "latest_before",
        how="max", inclusive=False,
    ).withColumn(
        "backwards",
        F.coalesce(F.col("effective_from") < F.col("latest_before"), F.lit(False)),
    )
    good = with_next(
        judged.where(~F.col("backwards")), ["revision_id"], ["ingest_seq"],
        F.col("effective_from"), bucket, "effective_to",
    )
    bad = judged.where(F.col("backwards")).withColumn(
        "effective_to", F.lit(None).cast("timestamp_ntz")
    )
    return good.unionByName(bad).drop("latest_before")


__all__ = [
    "PAYLOAD_FIELDS", "advance_current", "classify_append", "correction_chain", "current_revision", "first_arrivals", "match_intervals", "new_facts", "rebuild_current",
    "revision_numbers", "same_time_conflicts", "switch_revisions", "uncorrected", "with_keys",
]
