"""Audits over the stored tables derived from events, customers and nations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.checks import audit, constraints
from pricestrata.plans.batch import settle
from pricestrata.queries import query
from pricestrata.session import shared_folder
from pricestrata.sources import tables
from pricestrata.sources.seeds import categories

c = F.col
AS_OF = "2024-01-28 00:00:00"
NAMES = (
    "channel", "merchant", "listing", "revision", "run", "record", "observation", "current",
    "match", "variant", "item", "brand",
)


def store(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    tables = {n: bind.settled(bind.frame(spark, sf_dir, f"store_{n}")) for n in names or NAMES}
    if "record" in tables:
        part = F.struct(
            F.lit("response").alias("role"),
            F.when(c("manifest_other"), F.concat("raw_path", F.lit("x"))).otherwise(c("raw_path")).alias("relative_path"),
            c("manifest_hash").alias("source_hash"),
        )
        page = F.struct(
            F.lit("source_page").alias("role"),
            F.lit(None).cast("string").alias("relative_path"),
            c("raw_hash").alias("source_hash"),
        )
        tables["record"] = tables["record"].withColumn("artifact_manifest", F.array(part, page))
    tables["category"] = categories(spark)
    return tables


_REGION = "listing_id, region_scope, region_code"
SQL: dict[str, tuple[str, str, str]] = {
    "current_pointer_mismatch": (
        "AUD-01", "current observation listing revision",
        """SELECT current_id FROM store_current p
           WHERE NOT EXISTS (SELECT 1 FROM store_observation o JOIN store_listing l ON l.listing_id = o.listing_id
             JOIN store_revision r ON r.revision_id = o.revision_id AND r.listing_id = o.listing_id
             WHERE o.observation_id = p.observation_id AND o.listing_id = p.listing_id
               AND o.revision_id = p.revision_id AND l.current_revision_id = p.revision_id
               AND o.quality_status = 'ACCEPTED' AND r.quality_status = 'ACCEPTED'
               AND o.region_scope = p.region_scope AND o.region_code = p.region_code
               AND o.observed_at = p.observed_at)""",
    ),
    "missing_current_pointer": (
        "AUD-02", "current observation listing",
        f"""SELECT DISTINCT {_REGION} FROM store_observation o WHERE quality_status = 'ACCEPTED'
            AND (listing_id, revision_id) IN (SELECT (listing_id, current_revision_id) FROM store_listing)
            AND (listing_id, region_scope, region_code) NOT IN
                (SELECT (listing_id, region_scope, region_code) FROM store_current)""",
    ),
    "outdated_current_pointer": (
        "AUD-03", "current observation",
        """SELECT DISTINCT p.current_id FROM store_current p JOIN store_observation o
             USING (listing_id, revision_id, region_scope, region_code)
           WHERE o.quality_status = 'ACCEPTED'
             AND (o.observed_at > p.observed_at OR o.supersedes_id = p.observation_id)""",
    ),
    "invalid_current_revision": (
        "AUD-04", "listing revision",
        """SELECT listing_id FROM store_listing l WHERE current_revision_id IS NOT NULL AND NOT EXISTS (
             SELECT 1 FROM store_revision r WHERE r.revision_id = l.current_revision_id
               AND r.listing_id = l.listing_id AND r.quality_status = 'ACCEPTED')""",
    ),
    "outdated_current_revision": (
        "AUD-05", "listing observation",
        """SELECT DISTINCT l.listing_id FROM store_listing l JOIN store_observation n ON n.listing_id = l.listing_id
           LEFT JOIN (SELECT listing_id, revision_id, max(observed_at) AS own FROM store_observation
                      WHERE quality_status = 'ACCEPTED' GROUP BY ALL) o
             ON o.listing_id = l.listing_id AND o.revision_id = l.current_revision_id
           WHERE n.quality_status = 'ACCEPTED' AND (l.current_revision_id IS NULL
             OR (n.revision_id <> l.current_revision_id AND (own IS NULL OR own < n.observed_at)))""",
    ),
    "observation_identity_mismatch": (
        "AUD-06", "observation revision listing record run",
        """SELECT observation_id FROM store_observation o WHERE NOT EXISTS (
             SELECT 1 FROM store_revision r JOIN store_listing l ON l.listing_id = r.listing_id
               JOIN store_record e ON e.record_id = o.record_id JOIN store_run n ON n.run_id = e.run_id
             WHERE r.revision_id = o.revision_id AND l.listing_id = o.listing_id
               AND r.quality_status = 'ACCEPTED' AND l.price_nature = o.price_nature
               AND coalesce(e.listing_id, l.listing_id) = l.listing_id AND n.channel_id = l.channel_id
               AND (n.region_scope = 'MULTI' OR (n.region_scope = o.region_scope AND n.region_code = o.region_code)))""",
    ),
    "revision_evidence_mismatch": (
        "AUD-07", "revision listing record run",
        """SELECT revision_id FROM store_revision r WHERE NOT EXISTS (
             SELECT 1 FROM store_listing l JOIN store_record e ON e.record_id = r.first_record_id
               JOIN store_run n ON n.run_id = e.run_id AND n.channel_id = l.channel_id
             WHERE l.listing_id = r.listing_id AND coalesce(e.listing_id, l.listing_id) = l.listing_id)""",
    ),
    "untraceable_accepted_observation": (
        "AUD-08", "observation record",
        """SELECT observation_id FROM store_observation o WHERE quality_status = 'ACCEPTED' AND NOT EXISTS (
             SELECT 1 FROM store_record e WHERE e.record_id = o.record_id AND e.fetch_status = 'SUCCEEDED'
               AND (e.parse_status = 'SUCCEEDED' OR coalesce(e.error_code, '') = 'OFF_SHELF_CONFIRMED')
               AND e.raw_hash IS NOT NULL AND e.raw_path IS NOT NULL
               AND (e.entity_type <> 'PRODUCT' OR (e.raw_hash = o.source_hash AND e.fetched_at = o.observed_at)))""",
    ),
    "invalid_same_time_correction": (
        "AUD-09", "observation record",
        """SELECT observation_id FROM store_observation o WHERE supersedes_id IS NOT NULL AND NOT EXISTS (
             SELECT 1 FROM store_observation p JOIN store_record e ON e.record_id = o.record_id
             WHERE p.observation_id = o.supersedes_id AND p.observation_id < o.observation_id
               AND (p.listing_id, p.revision_id, p.region_scope, p.region_code, p.observed_at)
                 = (o.listing_id, o.revision_id, o.region_scope, o.region_code, o.observed_at)
               AND p.quality_status = 'ACCEPTED' AND o.quality_status = 'ACCEPTED'
               AND e.entity_type <> 'PRODUCT')""",
    ),
    "ambiguous_same_time_observations": (
        "AUD-10", "observation",
        f"""SELECT {_REGION}, observed_at, count(*) AS active FROM store_observation
            WHERE quality_status = 'ACCEPTED' AND observation_id NOT IN (SELECT supersedes_id FROM store_observation
              WHERE supersedes_id IS NOT NULL AND quality_status = 'ACCEPTED')
            GROUP BY ALL HAVING count(*) > 1""",
    ),
    "overlapping_accepted_matches": (
        "AUD-11", "match",
        """SELECT a.revision_id, count(*) AS pairs FROM store_match a JOIN store_match b
             ON a.revision_id = b.revision_id AND a.match_id < b.match_id
           WHERE a.match_status = 'ACCEPTED' AND b.match_status = 'ACCEPTED'
             AND a.effective_from < coalesce(b.effective_to, DATE '9999-12-31')
             AND b.effective_from < coalesce(a.effective_to, DATE '9999-12-31') GROUP BY 1""",
    ),
    "device_match_cardinality": (
        "AUD-12", "listing channel match",
        """SELECT listing_id FROM store_listing l JOIN store_channel c USING (channel_id)
           WHERE source_type = 'OFFICIAL_MALL' AND current_revision_id IS NOT NULL
             AND (SELECT count(*) FROM store_match m WHERE m.revision_id = l.current_revision_id
                  AND m.match_status = 'ACCEPTED' AND m.effective_to IS NULL) <> 1""",
    ),
    "invalid_official_scope": (
        "AUD-13", "listing channel merchant",
        """SELECT listing_id FROM store_listing l JOIN store_channel c ON c.channel_id = l.channel_id
           JOIN store_merchant m ON m.merchant_id = l.merchant_id
           WHERE NOT (m.channel_id = l.channel_id AND (source_type <> 'OFFICIAL_MALL' OR
             (business_mode = 'SELF_OPERATED' AND region_mode = 'NATIONAL' AND currency = 'CNY'
              AND price_nature = 'RETAIL_OFFER' AND seller_type = 'BRAND_OFFICIAL'
              AND verification_status = 'VERIFIED')))""",
    ),
    "invalid_batch_terminal_state": (
        "AUD-14", "run",
        """SELECT run_id FROM store_run WHERE NOT CASE status
             WHEN 'RUNNING' THEN finished_at IS NULL
             WHEN 'SUCCEEDED' THEN finished_at IS NOT NULL AND accepted_count <> 0 AND failed_count <= 0
             WHEN 'PARTIAL' THEN finished_at IS NOT NULL AND accepted_count <> 0
             ELSE finished_at IS NOT NULL END""",
    ),
    "invalid_observation_semantics": (
        "AUD-15", "observation",
        """SELECT observation_id FROM store_observation WHERE
             currency <> 'CNY' OR (region_scope = 'NATIONAL' AND region_code <> 'CN')
             OR (original_price IS NULL) <> (original_price_type = 'NONE')
             OR original_price <= 0 OR current_price <= 0
             OR (quality_status = 'ACCEPTED') <> (rejection_code IS NULL)
             OR (quality_status = 'ACCEPTED' AND price_nature = 'RETAIL_OFFER' AND original_price < current_price)
             OR NOT (quality_status <> 'ACCEPTED'
               OR (price_type = 'AVAILABILITY_ONLY' AND price_nature = 'RETAIL_OFFER' AND region_scope <> 'UNKNOWN'
                   AND availability IN ('OFF_SHELF', 'OUT_OF_STOCK', 'COMING_SOON') AND current_price IS NULL
                   AND original_price IS NULL AND pricing_basis = 'UNKNOWN' AND fee_status = 'NOT_APPLICABLE')
               OR (current_price IS NOT NULL AND region_scope <> 'UNKNOWN' AND price_nature <> 'UNKNOWN'
                   AND pricing_basis IN ('PACKAGE_TOTAL', 'UNIT_QUOTED')
                   AND ((price_nature LIKE '%OFFER' AND price_type = 'DIRECT_UNCONDITIONAL'
                         AND fee_status IN ('ITEM_ONLY', 'SEPARATE_FEES_EXCLUDED'))
                     OR (price_nature LIKE '%AVERAGE' AND price_type = 'PUBLISHED_VALUE'
                         AND fee_status = 'NOT_APPLICABLE'))))""",
    ),
    "device_standard_identity_mismatch": (
        "AUD-16", "listing channel revision match variant item brand",
        """SELECT match_id FROM store_listing l JOIN store_channel c USING (channel_id)
             JOIN store_revision r ON r.revision_id = l.current_revision_id
             JOIN store_match m ON m.revision_id = r.revision_id JOIN store_variant v USING (variant_id)
             JOIN store_item i USING (item_no) LEFT JOIN store_brand b USING (brand_id)
           WHERE source_type = 'OFFICIAL_MALL' AND match_status = 'ACCEPTED' AND effective_to IS NULL
             AND (canonical_key IS DISTINCT FROM sha256('["' || b.code || '","' || c.code || '","' || external_product_id || '"]')
               OR item_type <> 'MODEL' OR category_code <> 'PHONE' OR v.identity_fingerprint <> r.identity_fingerprint
               OR v.attributes <> r.normalized_attributes OR base_unit <> 'PIECE' OR quantity_value <> 1)""",
    ),
    "invalid_artifact_reference": (
        "AUD-17", "record",
        """SELECT record_id FROM store_record WHERE raw_path = '' OR (raw_path IS NOT NULL AND raw_hash IS NULL)
             OR raw_path LIKE '/%' OR contains(raw_path, '..') OR NOT regexp_full_match(manifest_hash, '[0-9a-f]{64}')
             OR (NOT manifest_other AND raw_hash <> manifest_hash)""",
    ),
}
WARN_SQL: dict[str, tuple[str, str, str]] = {
    "channels_without_completed_run": (
        "AUD-18", "channel run",
        """SELECT channel_id FROM store_channel WHERE enabled AND channel_id NOT IN (SELECT channel_id FROM store_run
             WHERE status IN ('SUCCEEDED', 'PARTIAL') AND accepted_count > 0)""",
    ),
    "stale_running_crawl": (
        "AUD-19", "run",
        f"""SELECT run_id FROM store_run WHERE status = 'RUNNING'
              AND started_at < TIMESTAMP '{AS_OF}' - INTERVAL 90 MINUTE""",
    ),
    "stale_current_price": (
        "AUD-20", "current listing channel",
        f"""SELECT current_id FROM store_current JOIN store_listing USING (listing_id) JOIN store_channel USING (channel_id)
            WHERE enabled AND observed_at < TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR""",
    ),
    "recent_unconfirmed_price_changes": (
        "AUD-21", "observation",
        f"""SELECT observation_id FROM store_observation WHERE rejection_code = 'PRICE_CHANGE_UNCONFIRMED'
              AND observed_at >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR""",
    ),
    "listings_waiting_off_shelf_confirmation": (
        "AUD-22", "listing channel",
        """SELECT listing_id FROM store_listing JOIN store_channel USING (channel_id) WHERE enabled
             AND source_type = 'OFFICIAL_MALL' AND consecutive_misses > 0 AND lifecycle_status <> 'INACTIVE'""",
    ),
}


def as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _register(name: str, ids: str, tables: str, sql: str, check: Callable[[], Callable]) -> None:
    views = [f"store_{n}" for n in tables.split()]

    @query(f"audit_{name}", ids, ctes(*views) + sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check()(store(spark, sf_dir, *tables.split()))


for _name, (_ids, _tables, _sql) in SQL.items():
    _register(_name, _ids, _tables, _sql, lambda n=_name: audit.CRITICAL[n])
for _name, (_ids, _tables, _sql) in WARN_SQL.items():
    _register(_name, _ids, _tables, _sql, lambda n=_name: audit.warnings(as_of(), 90, 72)[n])

_REPORT = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, '{severity}' AS severity, "
    + ("CAST(coalesce(sum(pairs), 0) AS BIGINT)" if n == "overlapping_accepted_matches" else "count(*)")
    + f" AS failures FROM ({sql})"
    for severity, group in (("critical", SQL), ("warning", WARN_SQL))
    for n, (_, _, sql) in group.items()
)


@query("audit_report", "AUD-23", ctes(*[f"store_{n}" for n in NAMES]) + _REPORT)
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived tables are written once, as a store would hold them, and read by all checks."""
    tables = store(spark, sf_dir)
    return audit.report({n: settle(t, f"audit-{n}") for n, t in tables.items()}, as_of())


@query(
    "observation_rule_violations",
    "RUL-14",
    ctes("store_observation")
    + """SELECT observation_id, array_to_string(list_filter([
           CASE WHEN currency <> 'CNY' THEN 'currency' END,
           CASE WHEN original_price <= 0 THEN 'original_price' END,
           CASE WHEN current_price <= 0 THEN 'current_price' END,
           CASE WHEN (original_price IS NULL) <> (original_price_type = 'NONE') THEN 'original_price_semantics' END,
           CASE WHEN (quality_status = 'ACCEPTED') <> (rejection_code IS NULL) THEN 'quality_semantics' END,
           CASE WHEN quality_status = 'ACCEPTED' AND NOT (
               (price_type = 'AVAILABILITY_ONLY' AND price_nature = 'RETAIL_OFFER' AND region_scope <> 'UNKNOWN'
                   AND availability IN ('OFF_SHELF', 'OUT_OF_STOCK', 'COMING_SOON') AND current_price IS NULL
                   AND original_price IS NULL AND pricing_basis = 'UNKNOWN' AND fee_status = 'NOT_APPLICABLE')
               OR (current_price IS NOT NULL AND region_scope <> 'UNKNOWN' AND price_nature <> 'UNKNOWN'
                   AND pricing_basis IN ('PACKAGE_TOTAL', 'UNIT_QUOTED')
                   AND ((price_nature LIKE '%OFFER' AND price_type = 'DIRECT_UNCONDITIONAL'
                         AND fee_status IN ('ITEM_ONLY', 'SEPARATE_FEES_EXCLUDED'))
                     OR (price_nature LIKE '%AVERAGE' AND price_type = 'PUBLISHED_VALUE'
                         AND fee_status = 'NOT_APPLICABLE')))) THEN 'accepted_eligibility' END,
           CASE WHEN region_scope = 'NATIONAL' AND region_code <> 'CN' THEN 'national_region' END],
           lambda x: x IS NOT NULL), ',') AS broken FROM store_observation""",
)
def observation_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = store(spark, sf_dir, "observation")["observation"]
    return constraints.violations(rows, "observation").select(
        "observation_id", F.array_join("violations", ",").alias("broken")
    )


@query(
    "fact_write_faults",
    "RUL-15",
    ctes("store_observation", "store_listing", "store_merchant", "store_revision", "store_record", "store_run")
    + """SELECT o.observation_id, CASE
           WHEN l.listing_id IS NULL THEN 'LISTING_UNKNOWN'
           WHEN l.channel_id IS DISTINCT FROM m.channel_id THEN 'MERCHANT_OF_OTHER_CHANNEL'
           WHEN r.revision_id IS NULL OR r.listing_id <> o.listing_id OR r.quality_status <> 'ACCEPTED'
             THEN 'REVISION_NOT_ACCEPTED_OF_LISTING'
           WHEN o.price_nature <> l.price_nature THEN 'PRICE_NATURE_DIFFERS'
           WHEN n.run_id IS NULL THEN 'EVIDENCE_UNKNOWN'
           WHEN e.listing_id <> o.listing_id THEN 'EVIDENCE_OF_OTHER_LISTING'
           WHEN n.channel_id <> l.channel_id THEN 'EVIDENCE_OF_OTHER_CHANNEL'
           WHEN n.region_scope <> 'MULTI' AND (n.region_scope, n.region_code) <> (o.region_scope, o.region_code)
             THEN 'REGION_DIFFERS_FROM_RUN' END AS write_fault
         FROM store_observation o LEFT JOIN store_listing l ON l.listing_id = o.listing_id
         LEFT JOIN store_merchant m ON m.merchant_id = l.merchant_id
         LEFT JOIN store_revision r ON r.revision_id = o.revision_id
         LEFT JOIN store_record e ON e.record_id = o.record_id LEFT JOIN store_run n ON n.run_id = e.run_id""",
)
def fact_write_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = store(spark, sf_dir)
    return constraints.write_faults(
        t["observation"], t["listing"], t["merchant"], t["revision"], t["record"], t["run"]
    ).select("observation_id", "write_fault")


@query(
    "variant_current_prices",
    "JON-03",
    ctes("store_match", "store_listing", "store_channel", "store_current", "store_observation")
    + """SELECT m.variant_id, l.listing_id, l.channel_id, o.price_nature, o.region_code, o.current_price, o.observed_at
         FROM store_match m JOIN store_listing l ON l.current_revision_id = m.revision_id
         JOIN store_channel c ON c.channel_id = l.channel_id
         JOIN store_current p ON p.listing_id = l.listing_id AND p.revision_id = m.revision_id
         JOIN store_observation o ON o.observation_id = p.observation_id AND o.observed_at = p.observed_at
         WHERE m.match_status = 'ACCEPTED' AND m.effective_to IS NULL""",
)
def variant_current_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricestrata.plans.reads import current_prices_of_variants

    t = store(spark, sf_dir, "match", "listing", "channel", "current", "observation")
    return current_prices_of_variants(t).select(
        "variant_id", "listing_id", "channel_id", "price_nature", "region_code", "current_price",
        "observed_at",
    )


@query(
    "typed_price_star",
    "SRC-01 JON-02",
    ctes("store_observation", "store_listing", "store_channel", "store_record")
    + """SELECT CAST(o.observation_id AS VARCHAR) AS observation_key, CAST(o.listing_id AS VARCHAR) AS listing_id, CAST(l.channel_id AS VARCHAR) AS channel_id,
           c.source_type, e.raw_path, o.current_price, CAST(o.observed_at AS TIMESTAMP) AS observed_at
         FROM store_observation o JOIN store_listing l ON l.listing_id = o.listing_id
         JOIN store_channel c ON c.channel_id = l.channel_id LEFT JOIN store_record e ON e.record_id = o.record_id
         WHERE o.quality_status = 'ACCEPTED'""",
)
def typed_price_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written and read by their declared schemas; the reads take the columns that the join needs."""
    root = shared_folder(spark, "typed")
    for name in ("observation", "listing", "channel", "record"):
        rows = bind.frame(spark, sf_dir, f"store_{name}").withColumnRenamed("observation_id", "observation_key")
        known = set(tables.schema(name).names)
        tables.write_table(rows.select(*(x for x in rows.columns if x in known)), root, name)
    o, l, ch, e = (tables.read_table(spark, root, n) for n in ("observation", "listing", "channel", "record"))
    facts = o.where("quality_status = 'ACCEPTED'").select(
        "observation_key", "listing_id", "record_id", "current_price", "observed_at"
    )
    return (
        facts.join(l.select("listing_id", "channel_id"), "listing_id")
        .join(ch.select("channel_id", "source_type"), "channel_id")
        .join(e.select("record_id", "raw_path"), "record_id", "left")
        .drop("record_id")
    )
