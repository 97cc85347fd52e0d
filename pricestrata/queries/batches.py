"""Scope, trust and evidence gates, the document batch, and replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.functions import vocab
from pricestrata.operators import gates
from pricestrata.operators.policy import POLICIES, evaluate, gate, register_policy
from pricestrata.plans import batch, replay
from pricestrata.queries import query
from pricestrata.queries.captures import _UNITS, UNIT
from pricestrata.queries.evidence import _MARKET_ROWS, market_docs
from pricestrata.queries.prices import candidates, price_facts
from pricestrata.queries.sqltext import facts, gated

c = F.col


@query(
    "scope_gate",
    "RUL-11",
    ctes("points")
    + """SELECT ingest_seq, CASE WHEN k % 4 = 3 THEN 'CATEGORY_OUT_OF_SCOPE'
           WHEN region_scope <> 'PROVINCE' OR region_code <> 'CLICK' THEN 'REGION_OUT_OF_SCOPE' END AS reason FROM points""",
)
def scope_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scope = gates.Scope("PROVINCE", "CLICK", ("phone", " TABLET ", "WATCH"))
    kind = F.expr(bind.pick("k", ["PHONE", "TABLET", "WATCH", "LAPTOP"]))
    rows = bind.frame(spark, sf_dir, "points").withColumn("category_code", kind)
    return gates.with_reason(rows, gates.scope_reason(scope)).select("ingest_seq", "reason")


@query(
    "trust_gate",
    "RUL-12",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 5 = 1 THEN 'PRODUCT_BRAND_MISMATCH'
         WHEN l_suppkey % 4 = 0 OR l_returnflag = 'N' OR l_suppkey % 7 = 1 THEN 'SELLER_UNTRUSTED'
         WHEN l_linestatus = 'F' THEN 'DEVICE_EVIDENCE_OVERRIDE' END AS reason FROM lineitem""",
)
def trust_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.frame(spark, sf_dir, "lineitem").withColumns(
        {
            "brand_code": F.when(c("l_partkey") % 5 == 1, "OPPO").otherwise("VIVO"),
            "price_nature": F.when(c("l_suppkey") % 4 == 0, "UNKNOWN").otherwise("RETAIL_OFFER"),
            "seller_type": F.when(c("l_returnflag") == "N", "THIRD_PARTY").otherwise("BRAND_OFFICIAL"),
            "verification_status": F.when(c("l_suppkey") % 7 == 1, "UNVERIFIED").otherwise("VERIFIED"),
            "source_observed_at": F.lit(None).cast("timestamp_ntz"),
            "evidence_hash": F.when(c("l_linestatus") == "F", "x"),
        }
    )
    return gates.with_reason(rows, gates.trust_reason(F.lit(" vivo "))).select(
        "l_orderkey", "l_linenumber", "l_partkey", "reason"
    )


@query(
    "evidence_gate",
    "RUL-13",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 3 THEN 404 ELSE 200 END AS http_status,
          CASE o_custkey % 5 WHEN 0 THEN 'text/html' WHEN 1 THEN '' ELSE 'application/vnd.ms-excel' END AS content_type,
          o_orderkey % 13 = 4 AS torn, CAST(o_orderdate AS DATE) AS d FROM orders)
       SELECT o_orderkey, CASE WHEN http_status = 404 THEN 'HTTP_STATUS' WHEN torn OR content_type = 'text/html' THEN 'ATTACHMENT_INVALID'
           WHEN o_orderkey % 17 = 5 THEN 'SOURCE_DATE_INVALID' WHEN o_orderkey % 19 = 6 THEN 'SOURCE_DATE_MISMATCH'
           WHEN o_orderkey % 23 = 7 THEN 'SOURCE_DATE_MISMATCH' END AS workbook_reason,
         CASE WHEN http_status = 404 THEN 'HTTP_STATUS' WHEN content_type = 'application/vnd.ms-excel' THEN 'CONTENT_TYPE'
           WHEN o_orderkey % 17 = 5 THEN 'SOURCE_DATE_INVALID' WHEN o_orderkey % 19 = 6 THEN 'SOURCE_DATE_MISMATCH'
           WHEN o_orderkey % 23 = 7 THEN 'SOURCE_DATE_MISMATCH' END AS page_reason FROM r""",
)
def evidence_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = c("o_orderdate").cast("date")
    rows = bind.frame(spark, sf_dir, "orders").withColumns(
        {
            "http_status": F.when(c("o_orderkey") % 11 == 3, 404).otherwise(200),
            "content_type": F.expr(
                "CASE o_custkey % 5 WHEN 0 THEN 'text/html' WHEN 1 THEN '' ELSE 'application/vnd.ms-excel' END"
            ),
            "head_hex": F.when(c("o_orderkey") % 13 == 4, "504B0304").otherwise("d0cf11e0a1b11ae1"),
            "expected_date": day,
            "found_date": F.when(c("o_orderkey") % 17 != 5, F.when(c("o_orderkey") % 19 == 6, F.date_add(day, 1)).otherwise(day)),
            "source_observed_at": c("o_orderdate"),
            "fetched_at": c("o_orderdate") - F.make_dt_interval(F.lit(0), F.lit(0), F.when(c("o_orderkey") % 23 == 7, 6).otherwise(5)),
        }
    )
    return rows.select(
        "o_orderkey",
        gates.evidence_reason("WORKBOOK").alias("workbook_reason"),
        gates.evidence_reason("HTML").alias("page_reason"),
    )


_NAME = {row[1]: row[2] for row in vocab.WHOLESALE_COMMODITIES}
_MARKET_FACTS = _MARKET_ROWS + f""",
named AS (SELECT *, doc_id AS record, 'mofcom-bj:' || commodity_id || ':market:' || market_id || ':unit:kg' AS listing_key,
    {'MAP {' + ', '.join(f"'{k}': '{v}'" for k, v in _NAME.items()) + '}'}[commodity_id] AS commodity_name FROM market),
evid AS (SELECT *, sha256('["MOFCOM_FRESH_WHOLESALE","' || source_date || '","' || commodity_id || '","' || commodity_name || '","元/公斤","'
    || market_id || '","' || market_name || '","' || region_code || '","' || price_text || '"]') AS source_hash FROM named),
uniq AS (SELECT listing_key, region_code, observed_at, source_hash, price, price_text, min(record) AS record
  FROM evid GROUP BY ALL),
linked AS (SELECT *, lag(source_hash) OVER (PARTITION BY listing_key, region_code, observed_at ORDER BY record) AS prior_hash FROM uniq)"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = batch.judge_documents(batch.parse(batch.MARKET_CHANNEL, market_docs(spark, sf_dir)))
    return batch.settle(judged, "market-batch")


@query(
    "document_batch_facts",
    "MRG-09 UDF-02 FN-33 WIN-08",
    ctes("market_pages", extra=_MARKET_FACTS)
    + """SELECT listing_key, region_code, observed_at, price AS current_price, source_hash, 'ACCEPTED' AS quality_status,
           CAST(price AS DECIMAL(20,6)) AS unit_price, 'CNY_PER_KG' AS unit_price_unit, prior_hash IS NOT NULL AS corrects FROM linked""",
)
def document_batch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market pages through parse, identity, gate and correction chain to facts."""
    return batch.document_facts(_judged(spark, sf_dir), "market-pages-1").select(
        "listing_key", "region_code", "observed_at", "current_price", "source_hash", "quality_status",
        "unit_price", "unit_price_unit", c("supersedes_key").isNotNull().alias("corrects"),
    )


@query(
    "document_batch_current",
    "MRG-09 WIN-01",
    ctes("market_pages", extra=_MARKET_FACTS)
    + """, tip AS (SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY listing_key, region_code
             ORDER BY observed_at DESC, record DESC) = 1)
         SELECT sha256('MOFCOM_FRESH_WHOLESALE|mofcom-bj-market:' || split_part(listing_key, ':', 4) || '|' || listing_key) AS listing_id,
           region_code, price AS current_price, observed_at FROM tip""",
)
def document_batch_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.outputs(_judged(spark, sf_dir), "market-pages-1")["current"].select(
        "listing_id", "region_code", "current_price", "observed_at"
    )


_SEEN = "min(observed_at) AS first_seen_at, max(observed_at) AS last_seen_at"
_LISTING_ID = (
    "sha256('MOFCOM_FRESH_WHOLESALE|mofcom-bj-market:' || market_id || '|' || listing_key)"
)


def _output(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return batch.outputs(_judged(spark, sf_dir), "market-pages-1")[name]


@query(
    "document_batch_merchants",
    "MRG-09 MRG-03 AGG-10",
    ctes("market_pages", extra=_MARKET_FACTS)
    + f"""SELECT 'MOFCOM_FRESH_WHOLESALE' AS channel, 'mofcom-bj-market:' || market_id AS merchant_key,
           min(market_name) AS name, {_SEEN} FROM evid GROUP BY market_id""",
)
def document_batch_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _output(spark, sf_dir, "merchant")


@query(
    "document_batch_listings",
    "MRG-09 MRG-03 AGG-10",
    ctes("market_pages", extra=_MARKET_FACTS)
    + f"""SELECT {_LISTING_ID} AS listing_id, 'MOFCOM_FRESH_WHOLESALE' AS channel,
           'mofcom-bj-market:' || market_id AS merchant_key, listing_key, {_SEEN} FROM evid
         GROUP BY market_id, listing_key""",
)
def document_batch_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _output(spark, sf_dir, "listing")


@query(
    "document_batch_revisions",
    "MRG-09 WIN-04",
    ctes("market_pages", extra=_MARKET_FACTS)
    + f"""SELECT {_LISTING_ID} AS listing_id, CAST(1 AS INT) AS revision_no, min(observed_at) AS first_observed_at,
           max(observed_at) AS last_observed_at FROM evid GROUP BY market_id, listing_key""",
)
def document_batch_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The attributes of a wholesale listing follow from its key, so each has one revision."""
    return _output(spark, sf_dir, "revision").select(
        "listing_id", "revision_no", "first_observed_at", "last_observed_at"
    )


@query(
    "document_batch_counts",
    "MRG-09",
    ctes("market_pages", extra=_MARKET_FACTS)
    + f"""SELECT 'merchant' AS output, count(DISTINCT market_id) AS rows FROM evid
         UNION ALL SELECT 'listing', count(DISTINCT {_LISTING_ID}) FROM evid
         UNION ALL SELECT 'revision', count(DISTINCT {_LISTING_ID}) FROM evid
         UNION ALL SELECT 'observation', count(*) FROM linked
         UNION ALL SELECT 'current', count(*) FROM (SELECT DISTINCT listing_key, region_code FROM linked)
         UNION ALL SELECT 'review', 0 UNION ALL SELECT 'rejected', 0""",
)
def document_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all seven outputs, each derived from the same written rows."""
    parts = batch.outputs(_judged(spark, sf_dir), "market-pages-1")
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("output"), "rows")
        for n, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "replayed_facts",
    "MRG-10",
    facts()
    + """SELECT observation_key, CAST(event_id AS VARCHAR) AS record_id,
           CASE WHEN k % 21 = 5 THEN 'ONLY_REPLAYED' WHEN k % 21 = 6 THEN 'ONLY_STORED'
                WHEN k % 21 = 7 AND (current_price IS NOT NULL) THEN 'DIFFERENT' ELSE 'MATCH' END AS verdict,
           CASE WHEN k % 21 IN (5, 6) THEN NULL WHEN k % 21 = 7 AND current_price IS NOT NULL THEN 'current_price'
                ELSE '' END AS changed_fields FROM facts""",
)
def replayed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store lacks some facts, holds some the replay does not see, and some other prices."""
    all_facts = price_facts(spark, sf_dir).withColumn("record_id", c("record_id").cast("string"))
    other = F.when(c("k") % 21 == 7, (c("current_price") + 1).cast("decimal(18,2)"))
    stored = all_facts.where(c("k") % 21 != 5).withColumn(
        "current_price", F.coalesce(other, c("current_price"))
    )
    return replay.compare_facts(all_facts.where(c("k") % 21 != 6), stored).select(
        "observation_key", "record_id", "verdict", "changed_fields"
    )


@query(
    "replay_status",
    "MRG-10",
    ctes("captured", extra=_UNITS)
    + """SELECT product_id, capture_day, status, CASE WHEN hash_day IN (3, 4)
           THEN CASE WHEN accepted_count > 0 THEN 'PARTIAL' ELSE 'FAILED' END ELSE status END AS replay_status
         FROM (SELECT *, EXTRACT(DAY FROM capture_day) % 6 AS hash_day FROM stated)""",
)
def replay_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pricestrata.operators.quality import unit_status

    units = unit_status(bind.frame(spark, sf_dir, "captured"), UNIT, "listing_id", "ingest_seq")
    named = units.withColumn("record_id", F.concat_ws("/", "product_id", c("capture_day").cast("string")))
    day = F.dayofmonth("capture_day") % 6
    code = F.when(day == 3, replay.UNCONFIRMED[0]).when(day == 4, replay.UNCONFIRMED[1]).when(day == 5, "OTHER")
    records = named.select("record_id", code.alias("error_code"))
    return replay.replay_status(named, records).select(
        "product_id", "capture_day", "status", "replay_status"
    )


@query(
    "recovered_contexts",
    "MRG-11",
    ctes("market_pages")
    + f"""SELECT doc_id AS record_id, fault,
            {'MAP {' + ', '.join(f"'{r[1]}': '{r[0]}'" for r in vocab.WHOLESALE_COMMODITIES) + '}'}[cid] AS commodity_code,
            CASE WHEN fault IS NULL THEN 'mofcom-bj:' || cid || ':' || source_date END AS dataset_key,
            CASE WHEN fault IS NULL THEN CAST(source_date AS TIMESTAMP) - INTERVAL 8 HOUR END AS observed_at
          FROM (SELECT *, CASE WHEN doc_id % 7 = 3 THEN '999' ELSE commodity_id END AS cid,
                  CASE WHEN doc_id % 11 = 5 THEN 'SOURCE_PAGE_AMBIGUOUS' WHEN doc_id % 13 = 6 THEN 'SOURCE_DATE_INVALID'
                       WHEN doc_id % 7 = 3 THEN 'COMMODITY_UNKNOWN' WHEN doc_id % 17 = 2 THEN 'ENTITY_KEY_DIFFERS' END AS fault FROM market_pages)""",
)
def recovered_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bind.settled(bind.frame(spark, sf_dir, "market_pages"))
    page = F.struct(
        F.lit("source_page").alias("role"),
        F.when(c("doc_id") % 13 == 6, "no date").otherwise(c("source_date").cast("string")).alias("source_date"),
    )
    key = F.concat_ws(":", F.lit("mofcom-bj"), "commodity_id", c("source_date").cast("string"))
    records = rows.select(
        c("doc_id").alias("record_id"),
        F.lit("PUBLIC_PRICE").alias("entity_type"),
        F.concat(
            F.lit("https://cif.mofcom.gov.cn/cif/seach.fhtml?commdityid="),
            F.when(c("doc_id") % 7 == 3, "999").otherwise(c("commodity_id")),
        ).alias("request_url"),
        F.concat(
            F.lit("PUBLIC_PRICE:"),
            F.sha2(F.when(c("doc_id") % 17 == 2, F.concat(key, F.lit("x"))).otherwise(key), 256),
        ).alias("entity_key"),
        F.when(c("doc_id") % 11 == 5, F.array(page, page)).otherwise(F.array(page)).alias("artifact_manifest"),
    )
    return replay.recover_context(records)


@query(
    "absence_replays",
    "MRG-12",
    """WITH l AS (SELECT l_orderkey, l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
        f AS (SELECT * FROM l WHERE l_partkey % 97 <> 5),
        g AS (SELECT l_orderkey, count(*) AS n, bool_or(l_partkey % 89 = 3) AS priced FROM f GROUP BY 1),
        p AS (SELECT l_orderkey, count(*) AS n FROM l GROUP BY 1)
       SELECT o_orderkey AS record_id, coalesce(o_orderkey % 5 <> 1 AND o_orderkey % 7 <> 2 AND g.n = p.n AND NOT priced, false) AS consistent
       FROM orders LEFT JOIN g ON g.l_orderkey = o_orderkey LEFT JOIN p ON p.l_orderkey = o_orderkey""",
)
def absence_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as absence records, their lines as the listings promised and stored."""
    day = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    number = c("o_orderkey").cast("string")
    records = bind.frame(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("record_id"),
        F.when(c("o_orderkey") % 5 == 1, 200).otherwise(404).alias("http_status"),
        F.lit("SUCCEEDED").alias("validation_status"),
        F.lit("SKIPPED").alias("parse_status"),
        F.concat(F.lit("https://x/"), number).alias("request_url"),
        F.concat(F.lit("https://x/"), F.when(c("o_orderkey") % 7 == 2, "home").otherwise(number)).alias("final_url"),
        F.concat(F.lit("https://x/"), number).alias("unit_url"),
        F.sha2(number, 256).alias("raw_hash"),
        day.alias("fetched_at"),
    )
    # Placed by record once: what follows groups and joins by it.
    placed = bind.frame(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").repartition("l_orderkey")
    lines = placed.groupBy(c("l_orderkey").alias("record_id"), c("l_partkey").alias("listing_id")).agg(F.min("l_suppkey").alias("revision_id"))
    stored = lines.where(c("listing_id") % 97 != 5).select(
        "record_id", "listing_id", "revision_id",
        F.lit("AVAILABILITY_ONLY").alias("price_type"),
        F.lit("OFF_SHELF").alias("availability"),
        F.lit("ACCEPTED").alias("quality_status"),
        F.when(c("listing_id") % 89 == 3, F.lit(1)).cast("decimal(18,2)").alias("current_price"),
        F.lit(None).cast("decimal(18,2)").alias("original_price"),
        F.sha2(c("record_id").cast("string"), 256).alias("source_hash"),
        day.alias("observed_at"),
    )
    return replay.check_absences(records, stored, lines)


def strict_gate(df: DataFrame, **scope: str) -> DataFrame:
    """The standard gate, and no price without an original to compare with."""
    judged = gate(df, **scope)
    bare = (c("quality_status") == "ACCEPTED") & c("original_price").isNull()
    return judged.withColumn(
        "rejection_code", F.when(bare, "ORIGINAL_MISSING").otherwise(c("rejection_code"))
    ).withColumn("quality_status", F.when(bare, "REJECTED").otherwise(c("quality_status")))


@query(
    "pluggable_policy",
    "UDF-03",
    gated()
    + """SELECT event_id, 'strict-1' AS policy_version,
           CASE WHEN quality_status = 'ACCEPTED' AND original_price IS NULL THEN 'ORIGINAL_MISSING' ELSE rejection_code END AS rejection_code
         FROM gated""",
)
def pluggable_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    if "strict-1" not in POLICIES:
        register_policy("strict-1", strict_gate)
    return evaluate(candidates(spark, sf_dir), "strict-1").select(
        "event_id", "policy_version", "rejection_code"
    )
