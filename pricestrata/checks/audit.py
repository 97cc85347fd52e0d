"""Consistency audits over the stored tables. Each check returns the keys that fail it.

Shapes chosen for scale: EXISTS with an inequality becomes one maximum per key, pointers meet
facts on their date as well as their id so that only touched partitions are read, and interval
overlap is counted by a sweep instead of a self join.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestrata.checks.constraints import observation_checks
from pricestrata.functions.device import item_key
from pricestrata.operators.lookups import overlap_counts

Tables = dict[str, DataFrame]
c = F.col
REGION = ["listing_id", "region_scope", "region_code"]


def _prefixed(df: DataFrame, prefix: str, names: list[str]) -> DataFrame:
    return df.select(*[c(n).alias(f"{prefix}_{n}") for n in names])


def _bad(condition: Column) -> Column:
    """SQL WHERE: unknown is not an error."""
    return F.coalesce(condition, F.lit(False))


def current_pointer_mismatch(t: Tables) -> DataFrame:
    fact = _prefixed(
        t["observation"], "f",
        ["observation_id", "observed_at", "quality_status", "revision_id", *REGION],
    )
    rev = _prefixed(t["revision"], "r", ["revision_id", "listing_id", "quality_status"])
    lst = _prefixed(t["listing"], "l", ["listing_id", "current_revision_id"])
    joined = (
        t["current"]
        .join(
            fact,
            (c("observation_id") == c("f_observation_id")) & (c("observed_at") == c("f_observed_at")),
            "left",
        )
        .join(lst, c("listing_id") == c("l_listing_id"), "left")
        .join(rev, c("revision_id") == c("r_revision_id"), "left")
    )
    wrong = (
        c("f_observation_id").isNull()
        | c("l_listing_id").isNull()
        | c("r_revision_id").isNull()
        | ~c("l_current_revision_id").eqNullSafe(c("revision_id"))
    )
    unequal = (
        (c("f_quality_status") != "ACCEPTED")
        | (c("r_quality_status") != "ACCEPTED")
        | (c("f_listing_id") != c("listing_id"))
        | (c("r_listing_id") != c("listing_id"))
        | (c("f_revision_id") != c("revision_id"))
        | (c("f_region_scope") != c("region_scope"))
        | (c("f_region_code") != c("region_code"))
    )
    return joined.where(wrong | _bad(unequal)).select("current_id")


def missing_current_pointer(t: Tables) -> DataFrame:
    chosen = t["listing"].select("listing_id", c("current_revision_id").alias("revision_id"))
    groups = (
        t["observation"]
        .where("quality_status = 'ACCEPTED'")
        .select(*REGION, "revision_id")
        .distinct()
        .join(chosen, ["listing_id", "revision_id"], "left_semi")
        .select(*REGION)
        .distinct()
    )
    return groups.join(t["current"].select(*REGION), REGION, "left_anti")


def outdated_current_pointer(t: Tables) -> DataFrame:
    """A pointer is outdated by a later accepted fact or by one that corrects its fact."""
    accepted = t["observation"].where("quality_status = 'ACCEPTED'")
    key = [*REGION, "revision_id"]
    newest = accepted.groupBy(*key).agg(F.max("observed_at").alias("newest"))
    later = t["current"].join(newest, key).where(c("newest") > c("observed_at"))
    correcting = accepted.where(c("supersedes_id").isNotNull()).select(
        *key, c("supersedes_id").alias("observation_id")
    )
    corrected = t["current"].join(correcting, [*key, "observation_id"], "left_semi")
    return later.select("current_id").union(corrected.select("current_id")).distinct()


def invalid_current_revision(t: Tables) -> DataFrame:
    rev = _prefixed(t["revision"], "r", ["revision_id", "listing_id", "quality_status"])
    held = t["listing"].where(c("current_revision_id").isNotNull())
    joined = held.join(rev, c("current_revision_id") == c("r_revision_id"), "left")
    wrong = (
        c("r_revision_id").isNull()
        | (c("r_listing_id") != c("listing_id"))
        | (c("r_quality_status") != "ACCEPTED")
    )
    return joined.where(_bad(wrong)).select("listing_id")


def outdated_current_revision(t: Tables) -> DataFrame:
    """Another revision has a trusted price newer than any of the current revision."""
    newest = (
        t["observation"]
        .where("quality_status = 'ACCEPTED'")
        .groupBy("listing_id", "revision_id")
        .agg(F.max("observed_at").alias("newest"))
    )
    own = c("revision_id") == c("current_revision_id")
    per_listing = (
        newest.join(t["listing"].select("listing_id", "current_revision_id"), "listing_id")
        .groupBy("listing_id", "current_revision_id")
        .agg(
            F.max(F.when(own, c("newest"))).alias("own"),
            F.max(F.when(~F.coalesce(own, F.lit(False)), c("newest"))).alias("other"),
        )
    )
    late = c("other").isNotNull() & (c("own").isNull() | (c("other") > c("own")))
    return per_listing.where(c("current_revision_id").isNull() | late).select("listing_id")


_RECORD = [
    "record_id", "run_id", "listing_id", "fetch_status", "parse_status", "error_code", "raw_hash",
    "raw_path", "entity_type", "fetched_at",
]


def _traced(facts: DataFrame, t: Tables) -> DataFrame:
    """Facts beside their revision (r_), listing (l_), record (e_) and run (n_)."""
    rev = _prefixed(t["revision"], "r", ["revision_id", "listing_id", "quality_status"])
    lst = _prefixed(t["listing"], "l", ["listing_id", "channel_id", "price_nature"])
    rec = _prefixed(t["record"], "e", _RECORD)
    run = _prefixed(t["run"], "n", ["run_id", "channel_id", "region_scope", "region_code"])
    return (
        facts.join(rev, c("revision_id") == c("r_revision_id"), "left")
        .join(lst, c("listing_id") == c("l_listing_id"), "left")
        .join(rec, c("record_id") == c("e_record_id"), "left")
        .join(run, c("e_run_id") == c("n_run_id"), "left")
    )


def _misidentified() -> Column:
    absent = (
        c("r_revision_id").isNull()
        | c("l_listing_id").isNull()
        | c("e_record_id").isNull()
        | c("n_run_id").isNull()
    )
    unequal = (
        (c("r_listing_id") != c("l_listing_id"))
        | (c("r_quality_status") != "ACCEPTED")
        | (c("price_nature") != c("l_price_nature"))
        | (c("e_listing_id") != c("l_listing_id"))
        | (c("n_channel_id") != c("l_channel_id"))
        | (
            (c("n_region_scope") != "MULTI")
            & ((c("n_region_scope") != c("region_scope")) | (c("n_region_code") != c("region_code")))
        )
    )
    return absent | _bad(unequal)


def observation_identity_mismatch(t: Tables) -> DataFrame:
    facts = t["observation"].select("observation_id", *REGION, "revision_id", "record_id", "price_nature")
    return _traced(facts, t).where(_misidentified()).select("observation_id")


def revision_evidence_mismatch(t: Tables) -> DataFrame:
    lst = _prefixed(t["listing"], "l", ["listing_id", "channel_id"])
    rec = _prefixed(t["record"], "e", ["record_id", "run_id", "listing_id"])
    run = _prefixed(t["run"], "n", ["run_id", "channel_id"])
    joined = (
        t["revision"]
        .join(lst, c("listing_id") == c("l_listing_id"), "left")
        .join(rec, c("first_record_id") == c("e_record_id"), "left")
        .join(run, c("e_run_id") == c("n_run_id"), "left")
    )
    absent = c("l_listing_id").isNull() | c("e_record_id").isNull() | c("n_run_id").isNull()
    unequal = (c("n_channel_id") != c("l_channel_id")) | (c("e_listing_id") != c("l_listing_id"))
    return joined.where(absent | _bad(unequal)).select("revision_id")


def _untraceable() -> Column:
    parsed = (c("e_parse_status") == "SUCCEEDED") | c("e_error_code").eqNullSafe(
        F.lit("OFF_SHELF_CONFIRMED")
    )
    wrong = (
        c("e_record_id").isNull()
        | (c("e_fetch_status") != "SUCCEEDED")
        | ~parsed
        | c("e_raw_hash").isNull()
        | c("e_raw_path").isNull()
        | (
            (c("e_entity_type") == "PRODUCT")
            & ((c("source_hash") != c("e_raw_hash")) | (c("observed_at") != c("e_fetched_at")))
        )
    )
    return _bad(c("quality_status") == "ACCEPTED") & _bad(wrong)


def untraceable_accepted_observation(t: Tables) -> DataFrame:
    rec = _prefixed(t["record"], "e", [x for x in _RECORD if x not in ("run_id", "listing_id")])
    joined = (
        t["observation"]
        .where("quality_status = 'ACCEPTED'")
        .select("observation_id", "record_id", "source_hash", "observed_at", "quality_status")
        .join(rec, c("record_id") == c("e_record_id"), "left")
    )
    return joined.where(_untraceable()).select("observation_id")


def invalid_same_time_correction(t: Tables) -> DataFrame:
    names = ["observation_id", "observed_at", "quality_status", "revision_id", *REGION]
    prior = _prefixed(t["observation"], "p", names)
    rec = _prefixed(t["record"], "e", ["record_id", "entity_type"])
    joined = (
        t["observation"]
        .where(c("supersedes_id").isNotNull())
        .select(*names, "supersedes_id", "record_id")
        .join(
            prior,
            (c("supersedes_id") == c("p_observation_id")) & (c("observed_at") == c("p_observed_at")),
            "left",
        )
        .join(rec, c("record_id") == c("e_record_id"), "left")
    )
    wrong = c("p_observation_id").isNull() | (c("p_observation_id") >= c("observation_id"))
    for name in ("revision_id", *REGION):
        wrong = wrong | (c(f"p_{name}") != c(name))
    wrong = (
        wrong
        | (c("e_entity_type") == "PRODUCT")
        | (c("p_quality_status") != "ACCEPTED")
        | (c("quality_status") != "ACCEPTED")
    )
    return joined.where(_bad(wrong)).select("observation_id")


def ambiguous_same_time_observations(t: Tables) -> DataFrame:
    accepted = t["observation"].where("quality_status = 'ACCEPTED'")
    replaced = accepted.where(c("supersedes_id").isNotNull()).select(
        c("supersedes_id").alias("observation_id")
    )
    return (
        accepted.select("observation_id", *REGION, "observed_at")
        .join(replaced, "observation_id", "left_anti")
        .groupBy(*REGION, "observed_at")
        .agg(F.count(F.lit(1)).alias("active"))
        .where("active > 1")
    )


def overlapping_accepted_matches(t: Tables) -> DataFrame:
    """Number of overlapping pairs per revision, without forming the pairs."""
    accepted = t["match"].where("match_status = 'ACCEPTED'").select(
        "revision_id", "effective_from", "effective_to"
    )
    far = F.lit("9999-12-31").cast(accepted.schema["effective_from"].dataType)
    counted = overlap_counts(
        accepted, ["revision_id"], "effective_from", "effective_to", F.year("__at"), far
    )
    pairs = counted.groupBy("revision_id").agg(F.sum("overlaps").alias("pairs"))
    return pairs.where("pairs > 0")


def device_match_cardinality(t: Tables) -> DataFrame:
    malls = t["channel"].where("source_type = 'OFFICIAL_MALL'").select("channel_id")
    opened = (
        t["match"]
        .where("match_status = 'ACCEPTED' AND effective_to IS NULL")
        .groupBy(c("revision_id").alias("current_revision_id"))
        .agg(F.count(F.lit(1)).alias("matches"))
    )
    return (
        t["listing"]
        .where(c("current_revision_id").isNotNull())
        .join(malls, "channel_id", "left_semi")
        .join(opened, "current_revision_id", "left")
        .where(F.coalesce("matches", F.lit(0)) != 1)
        .select("listing_id")
    )


def invalid_official_scope(t: Tables) -> DataFrame:
    merchant = _prefixed(
        t["merchant"], "m", ["merchant_id", "channel_id", "seller_type", "verification_status"]
    )
    official = (
        (c("business_mode") != "SELF_OPERATED")
        | (c("region_mode") != "NATIONAL")
        | (c("currency") != "CNY")
        | (c("price_nature") != "RETAIL_OFFER")
        | (c("m_seller_type") != "BRAND_OFFICIAL")
        | (c("m_verification_status") != "VERIFIED")
    )
    wrong = (c("m_channel_id") != c("channel_id")) | (
        (c("source_type") == "OFFICIAL_MALL") & official
    )
    return (
        t["listing"]
        .join(t["channel"], "channel_id")
        .join(merchant, c("merchant_id") == c("m_merchant_id"))
        .where(_bad(wrong))
        .select("listing_id")
    )


def invalid_batch_terminal_state(t: Tables) -> DataFrame:
    running = c("status") == "RUNNING"
    wrong = (
        (running & c("finished_at").isNotNull())
        | (~running & c("finished_at").isNull())
        | (c("status").isin("SUCCEEDED", "PARTIAL") & (c("accepted_count") == 0))
        | ((c("status") == "SUCCEEDED") & (c("failed_count") > 0))
    )
    return t["run"].where(_bad(wrong)).select("run_id")


def _meaningless() -> Column:
    every = reduce(lambda a, b: a & b, [rule for _, rule in observation_checks()])
    below = (
        (c("quality_status") == "ACCEPTED")
        & (c("price_nature") == "RETAIL_OFFER")
        & (c("original_price") < c("current_price"))
    )
    return _bad(~every) | _bad(below)


def invalid_observation_semantics(t: Tables) -> DataFrame:
    """NOT of every declared rule; a rule that is unknown does not count as broken."""
    return t["observation"].where(_meaningless()).select("observation_id")


def device_standard_identity_mismatch(t: Tables) -> DataFrame:
    open_match = t["match"].where("match_status = 'ACCEPTED' AND effective_to IS NULL").select(
        "revision_id", "variant_id", "match_id"
    )
    variant = t["variant"].select(
        "variant_id", "item_no", "attributes", "measure_type", "base_unit", "quantity_value",
        c("identity_fingerprint").alias("variant_fingerprint"),
    )
    rev = t["revision"].select("revision_id", "identity_fingerprint", "normalized_attributes")
    profile = t["category"].select(
        c("code").alias("category_code"), c("attribute_profile_code").alias("profile")
    )
    brand = t["brand"].select("brand_id", c("code").alias("brand_code"))
    malls = t["channel"].where("source_type = 'OFFICIAL_MALL'").select(
        "channel_id", c("code").alias("channel_code")
    )
    joined = (
        t["listing"]
        .select("listing_id", "channel_id", "external_product_id",
                c("current_revision_id").alias("revision_id"))
        .join(malls, "channel_id")
        .join(rev, "revision_id")
        .join(open_match, "revision_id")
        .join(variant, "variant_id")
        .join(t["item"], "item_no")
        .join(brand, "brand_id", "left")
        .join(F.broadcast(profile), "category_code")
    )
    expected = item_key(c("brand_code"), c("channel_code"), c("external_product_id"))
    wrong = (
        ~c("canonical_key").eqNullSafe(expected)
        | (c("item_type") != "MODEL")
        | (c("profile") != "electronic-device")
        | (c("variant_fingerprint") != c("identity_fingerprint"))
        | (c("attributes") != c("normalized_attributes"))
        | (c("measure_type") != "COUNT")
        | (c("base_unit") != "PIECE")
        | (c("quantity_value") != 1)
    )
    return joined.where(_bad(wrong)).select("match_id")


def artifact_references(t: Tables) -> DataFrame:
    """Distinct (record, path, hash) references of records and their manifests, with faults."""
    both = c("raw_path").isNotNull() | c("raw_hash").isNotNull()
    half = both & (
        (F.coalesce("raw_path", F.lit("")) == "") | (F.coalesce("raw_hash", F.lit("")) == "")
    )
    own = F.when(
        both & ~half,
        F.array(F.struct(c("raw_path").alias("path"), c("raw_hash").alias("digest"))),
    ).otherwise(F.array().cast("array<struct<path:string,digest:string>>"))
    listed = F.transform(
        F.filter("artifact_manifest", lambda p: p["relative_path"].isNotNull()),
        lambda p: F.struct(
            p["relative_path"].alias("path"), p["source_hash"].alias("digest")
        ),
    )
    return t["record"].select(
        "record_id",
        half.alias("half_reference"),
        F.array_distinct(F.concat(own, listed)).alias("refs"),
    )


def invalid_artifact_reference(t: Tables) -> DataFrame:
    """Path shape, hash shape and agreement between record and manifest."""

    def broken(r: Column) -> Column:
        shape = (
            r["path"].startswith("/")
            | r["path"].rlike(r"(^|/)\.\.(/|\z)")
            | ~(r["digest"].rlike(r"^[0-9a-f]{64}\z"))
        )
        return (
            r["path"].isNull() | r["digest"].isNull() | (r["path"] == "") | shape
        )

    paths = F.transform("refs", lambda r: r["path"])
    torn = F.size(F.array_distinct(paths)) < F.size(paths)
    return (
        artifact_references(t)
        .where(c("half_reference") | F.exists("refs", broken) | torn)
        .select("record_id")
    )


def stored_references(t: Tables) -> DataFrame:
    """References in the form that ``stored.file_faults`` takes; every body is to be read."""
    named = artifact_references(t).select("record_id", F.inline("refs"))
    return named.select(
        "record_id", c("path").alias("relative_path"), "digest",
        F.lit(None).cast("bigint").alias("size"), F.lit(True).alias("asked"),
    )


def channels_without_completed_run(t: Tables) -> DataFrame:
    done = t["run"].where("status IN ('SUCCEEDED', 'PARTIAL') AND accepted_count > 0")
    return (
        t["channel"].where("enabled").join(done.select("channel_id"), "channel_id", "left_anti")
        .select("channel_id")
    )


def stale_running_crawl(t: Tables, as_of: Column, minutes: int) -> DataFrame:
    limit = as_of - F.expr(f"INTERVAL {minutes} MINUTE")
    return t["run"].where((c("status") == "RUNNING") & (c("started_at") < limit)).select("run_id")


def stale_current_price(t: Tables, as_of: Column, hours: int) -> DataFrame:
    enabled = t["channel"].where("enabled").select("channel_id")
    live = t["listing"].join(enabled, "channel_id", "left_semi").select("listing_id")
    old = t["current"].where(c("observed_at") < as_of - F.expr(f"INTERVAL {hours} HOUR"))
    return old.join(live, "listing_id", "left_semi").select("current_id")


def _recently_unconfirmed(as_of: Column) -> Column:
    since = as_of - F.expr("INTERVAL 24 HOUR")
    return _bad((c("rejection_code") == "PRICE_CHANGE_UNCONFIRMED") & (c("observed_at") >= since))


def recent_unconfirmed_price_changes(t: Tables, as_of: Column) -> DataFrame:
    return t["observation"].where(_recently_unconfirmed(as_of)).select("observation_id")


def listings_waiting_off_shelf_confirmation(t: Tables) -> DataFrame:
    malls = t["channel"].where("enabled AND source_type = 'OFFICIAL_MALL'").select("channel_id")
    return (
        t["listing"]
        .where((c("consecutive_misses") > 0) & (c("lifecycle_status") != "INACTIVE"))
        .join(malls, "channel_id", "left_semi")
        .select("listing_id")
    )


CRITICAL: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        current_pointer_mismatch, missing_current_pointer, outdated_current_pointer,
        invalid_current_revision, outdated_current_revision, observation_identity_mismatch,
        revision_evidence_mismatch, untraceable_accepted_observation,
        invalid_same_time_correction, ambiguous_same_time_observations,
        overlapping_accepted_matches, device_match_cardinality, invalid_official_scope,
        invalid_batch_terminal_state, invalid_observation_semantics,
        device_standard_identity_mismatch, invalid_artifact_reference,
    )
}


def warnings(as_of: Column, stale_minutes: int, stale_hours: int) -> dict[str, Callable[[Tables], DataFrame]]:
    """Freshness checks; the clock is a parameter, so a result can be repeated."""
    return {
        "channels_without_completed_run": channels_without_completed_run,
        "stale_running_crawl": lambda t: stale_running_crawl(t, as_of, stale_minutes),
        "stale_current_price": lambda t: stale_current_price(t, as_of, stale_hours),
        "recent_unconfirmed_price_changes": lambda t: recent_unconfirmed_price_changes(t, as_of),
        "listings_waiting_off_shelf_confirmation": listings_waiting_off_shelf_confirmation,
    }


def _counted(name: str, severity: str, failing: DataFrame) -> DataFrame:
    size = F.sum("pairs") if "pairs" in failing.columns else F.count(F.lit(1))
    return failing.agg(F.coalesce(size, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"), "failures"
    )


def fact_counts(t: Tables, as_of: Column) -> DataFrame:
    """The four checks on single facts in one pass over the facts and their evidence."""
    flags = {
        ("observation_identity_mismatch", "critical"): _misidentified(),
        ("untraceable_accepted_observation", "critical"): _untraceable(),
        ("invalid_observation_semantics", "critical"): _meaningless(),
        ("recent_unconfirmed_price_changes", "warning"): _recently_unconfirmed(as_of),
    }
    counts = _traced(t["observation"], t).agg(
        *[F.count_if(flag).alias(name) for (name, _), flag in flags.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), c(n).alias("failures"))
            for n, s in flags
        ]
    )
    return counts.select(F.inline(rows))


def report(t: Tables, as_of: Column, stale_minutes: int = 90, stale_hours: int = 72) -> DataFrame:
    """One row per check; healthy means every critical count is zero."""
    together = fact_counts(t, as_of)
    checks = [("critical", n, f) for n, f in CRITICAL.items()]
    checks += [("warning", n, f) for n, f in warnings(as_of, stale_minutes, stale_hours).items()]
    done = {
        "observation_identity_mismatch", "untraceable_accepted_observation",
        "invalid_observation_semantics", "recent_unconfirmed_price_changes",
    }
    parts = [_counted(n, severity, f(t)) for severity, n, f in checks if n not in done]
    return reduce(DataFrame.unionByName, [together, *parts])
