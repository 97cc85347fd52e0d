"""Read queries and join patterns: as-of, latest row, overlap, whitelist, coverage gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.operators.ordered import carry_forward, newest, running, time_bucket


def record_chain(
    records: DataFrame, runs: DataFrame, channels: DataFrame, run: Column, channel: Column
) -> DataFrame:
    """Evidence records with the run that made them and the channel of the run."""
    return records.join(runs, run).join(channels, channel)


def star(
    facts: DataFrame,
    dimensions: list[tuple[DataFrame, Column]],
    optional: list[tuple[DataFrame, Column]],
) -> DataFrame:
    """Facts with their dimensions; an optional one may be missing and keeps the fact.

    Optional dimensions must have one row per key, so that no fact is multiplied.
    """
    out = facts
    for table, on in dimensions:
        out = out.join(table, on)
    for table, on in optional:
        out = out.join(table, on, "left")
    return out


def same_values(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` whose columns equal a row of ``right``; two NULLs are equal."""
    named = right.select(*[F.col(x).alias(f"__r_{x}") for x in columns])
    if how in ("left_semi", "left_anti"):
        named = named.distinct()
    same = F.lit(True)
    for x in columns:
        same = same & F.col(x).eqNullSafe(F.col(f"__r_{x}"))
    return left.join(named, same, how)


def one_shape(products: DataFrame, documents: DataFrame, kind: str = "kind") -> DataFrame:
    """Product rows and document rows as one table; columns of the other side are NULL."""
    return products.withColumn(kind, F.lit("product")).unionByName(
        documents.withColumn(kind, F.lit("document")), allowMissingColumns=True
    )


def capped(
    rows: DataFrame, run: list[str], order: list[str], size: int, bucket: Column
) -> DataFrame:
    """Every row with its place in discovery order and whether it lies beyond the cap.

    ``size`` is how many products a run takes. Places are counted in buckets of the order, so
    one run with a third of the rows is not ordered in one task. ``order`` must be unique in a run.
    """
    placed = running(rows, run, order, F.lit(1), bucket, "place")
    return placed.withColumn("beyond_cap", F.col("place") > size)


def facts_of_records(facts: DataFrame, record: list[str], order: list[str]) -> DataFrame:
    """Facts in the order of their records, then of their ids; a range sort over all tasks."""
    return facts.orderBy(*record, *order)


def as_of(
    targets: DataFrame,
    facts: DataFrame,
    keys: list[str],
    target_time: str,
    fact_time: str,
    value: Column,
    bucket: str = "DAY",
    max_age: str | None = None,
    tie: str = "ingest_seq",
) -> DataFrame:
    """Last fact at or before each target time, optionally no older than ``max_age``.

    Facts and targets are merged into one ordered stream per key and time slice, so neither
    side is replicated and a hot key is spread over its slices.
    """
    names = [c for c in targets.columns if c not in keys]
    left = targets.select(
        *keys,
        F.col(target_time).alias("__t"),
        F.lit(1).alias("__side"),
        F.lit(None).cast("bigint").alias("__tie"),
        F.struct(*names).alias("__row"),
    )
    right = facts.select(
        *keys,
        F.col(fact_time).alias("__t"),
        F.lit(0).alias("__side"),
        F.col(tie).cast("bigint").alias("__tie"),
        F.struct(F.col(fact_time).alias("at"), value.alias("value")).alias("__fact"),
    )
    merged = left.unionByName(right, allowMissingColumns=True)
    filled = carry_forward(
        merged, keys, ["__t", "__side", "__tie"], F.col("__fact"), time_bucket("__t", bucket),
        "__hit",
    ).where("__side = 1")
    hit = F.col("__hit")
    if max_age is not None:
        hit = F.when(F.col("__hit.at") >= F.col("__t") - F.expr(f"INTERVAL {max_age}"), hit)
    return filled.select(
        *keys,
        *[F.col("__row")[n].alias(n) for n in names],
        hit["at"].alias("fact_time"),
        hit["value"].alias("fact"),
    )


def trajectory(facts: DataFrame, region: Column) -> DataFrame:
    """Facts of listings in a region in time order, corrected rows removed."""
    from pricestrata.operators.facts import uncorrected

    return uncorrected(facts.where(region)).orderBy("listing_id", "observed_at", "ingest_seq")


def latest_with_record(facts: DataFrame, records: DataFrame) -> DataFrame:
    """Newest accepted fact per listing joined to the evidence record it came from."""
    top = newest(
        facts.where(F.col("quality_status") == "ACCEPTED").select(
            "listing_id", "product_id", "record_id", "observed_at", "ingest_seq"
        ),
        ["listing_id"],
        [F.col("observed_at"), F.col("ingest_seq")],
    )
    return top.join(records, "record_id").where(F.col("entity_key") == F.col("product_id"))


def overlap_counts(
    intervals: DataFrame, keys: list[str], start: str, end: str, bucket: Column, far: Column
) -> DataFrame:
    """Per interval, how many earlier intervals of its key it overlaps; no pair is emitted.

    ``bucket`` must not decrease with ``__at``. Starts and ends become one event stream. Ends come before starts at the same instant, and
    an empty interval only looks at what is strictly open around it, so the sum over a key is
    the number of pairs with a.start < b.end and b.start < a.end.
    """
    closed = F.coalesce(F.col(end), far)
    base = intervals.withColumn("__end", closed)
    empty = F.col(start) == F.col("__end")
    names = intervals.columns
    opens = base.select(
        *names,
        F.col(start).alias("__at"),
        F.when(empty, 1).otherwise(2).alias("__rank"),
        F.when(empty, 0).otherwise(1).alias("__delta"),
    )
    closes = base.where(~empty).select(
        *names,
        F.col("__end").alias("__at"),
        F.lit(0).alias("__rank"),
        F.lit(-1).alias("__delta"),
    )
    swept = running(
        opens.unionByName(closes).withColumn("__slice", bucket),
        keys,
        ["__at", "__rank"],
        F.col("__delta"),
        F.col("__slice"),
        "__open",
    )
    return swept.where("__rank > 0").select(
        *names, (F.col("__open") - F.col("__delta")).alias("overlaps")
    )


def not_discovered(known: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    return known.join(found, key, "left_anti")


def superseded_by_newer(facts: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Rows for which a newer accepted row exists: an EXISTS with an inequality as one maximum."""
    top = (
        facts.where(F.col("quality_status") == "ACCEPTED")
        .groupBy(*keys)
        .agg(F.max(time).alias("__top"))
    )
    return facts.join(top, keys).where(F.col("__top") > F.col(time)).drop("__top")


def whitelist(
    rows: DataFrame, allowed: list[tuple], dims: list[str], doc: list[str]
) -> DataFrame:
    """One row per document and whitelisted combination, matched or not, with its matches.

    ``allowed`` is a literal list of (code, values of ``dims``). A combination that does not
    match exactly one row of the document is an error.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("entry_no"), F.lit(entry[0]).alias("commodity_code"),
                *[F.lit(v).alias(d) for d, v in zip(dims, entry[1:], strict=True)],
            )
            for i, entry in enumerate(allowed)
        ]
    )
    wanted = rows.select(*doc).distinct().select(*doc, F.inline(entries))
    hits = rows.groupBy(*doc, *dims).agg(
        F.count(F.lit(1)).alias("matches"), F.min("price").alias("price")
    )
    found = wanted.join(hits, [*doc, *dims], "left").withColumn(
        "matches", F.coalesce("matches", F.lit(0).cast("bigint"))
    )
    return found.select(
        *doc, "entry_no", "commodity_code", "matches", "price",
        F.when(F.col("matches") != 1, "COMMODITY_MAPPING_MISSING").alias("error_code"),
    )


def first_fault(rows: DataFrame, doc: list[str], order: str, error: Column) -> Column:
    """The first error of a document in entry order; documents have a fixed number of entries."""
    whole = Window.partitionBy(*doc)
    return F.min(F.when(error.isNotNull(), F.struct(F.col(order), error.alias("e")))).over(whole)["e"]


def coverage_gap(known: DataFrame, captured: DataFrame, key: list[str]) -> DataFrame:
    """Known identities a capture did not return, kept as rows."""
    return known.select(*key).distinct().join(captured, key, "left_anti")


def first_samples(rows: DataFrame, order: list[Column], size: int) -> DataFrame:
    """The first ``size`` rows of a report and whether there are more; a bounded top-k."""
    top = rows.orderBy(*order).limit(size + 1)
    whole = Window.partitionBy(F.lit(0))
    return (
        top.withColumn("truncated", F.count(F.lit(1)).over(whole) > size)
        .orderBy(*order)
        .limit(size)
    )
