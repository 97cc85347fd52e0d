"""Tables after two deliveries of market pages, each merged in one commit."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes
from pricestrata.plans import batch, commits
from pricestrata.queries import query
from pricestrata.queries.batches import _MARKET_FACTS, _judged
from pricestrata.session import shared_folder

c = F.col


@cache
def _store(app: str, sf_dir: str) -> str:
    """Two deliveries: pages of the first half of each month; then the others, with a part of the first again.
    The second comes twice."""
    spark = SparkSession.getActiveSession()
    root = shared_folder(spark, "store")
    judged = _judged(spark, sf_dir)
    early = F.dayofmonth(c("observed_at") + F.expr("INTERVAL 8 HOURS")) <= 15
    for name, part in (("a", early), ("b", ~early | (c("record_id") % 5 == 0)), ("b", ~early)):
        commits.apply_batch(spark, root, name, batch.settle(judged.where(part), "delivery"), "market-pages-1")
    return root


def _root(spark: SparkSession, sf_dir: str) -> str:
    return _store(spark.sparkContext.applicationId, sf_dir)


@query(
    "committed_facts",
    "SRC-12 MRG-09 WIN-08",
    ctes("market_pages", extra=_MARKET_FACTS)
    + """SELECT listing_key, region_code, observed_at, price AS current_price, source_hash, prior_hash IS NOT NULL AS corrects FROM linked""",
)
def committed_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = commits.read(spark, _root(spark, sf_dir), "observation")
    return rows.select(
        "listing_key", "region_code", "observed_at", "current_price", "source_hash",
        c("supersedes_key").isNotNull().alias("corrects"),
    )


@query(
    "committed_current",
    "MRG-09 MRG-04",
    ctes("market_pages", extra=_MARKET_FACTS)
    + """, tip AS (SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY listing_key, region_code
             ORDER BY observed_at DESC, record DESC) = 1)
         SELECT sha256('MOFCOM_FRESH_WHOLESALE|mofcom-bj-market:' || split_part(listing_key, ':', 4) || '|' || listing_key) AS listing_id,
           region_code, price AS current_price, observed_at FROM tip""",
)
def committed_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commits.current(spark, _root(spark, sf_dir)).select("listing_id", "region_code", "current_price", "observed_at")


@query(
    "committed_listings",
    "MRG-09 MRG-03 AGG-10",
    ctes("market_pages", extra=_MARKET_FACTS)
    + "SELECT listing_key, min(observed_at) AS first_seen_at, max(observed_at) AS last_seen_at FROM evid GROUP BY 1",
)
def committed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commits.seen(spark, _root(spark, sf_dir), "listing", ["listing_key"])
