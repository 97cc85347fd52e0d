"""Read plans over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col


def current_prices_of_variants(t: dict[str, DataFrame]) -> DataFrame:
    """Variant -> open match -> current revision -> pointer -> fact, with its channel.

    Starts from the pointer table, which is one row per listing and region, and reaches the
    facts by date and id so that only the partitions holding current facts are read.
    """
    matches = t["match"].where("match_status = 'ACCEPTED' AND effective_to IS NULL").select(
        "variant_id", "revision_id"
    )
    listings = t["listing"].select(
        "listing_id", "channel_id", c("current_revision_id").alias("revision_id")
    )
    pointers = t["current"].select("listing_id", "revision_id", "observation_id", "observed_at")
    facts = t["observation"].select(
        "observation_id", "observed_at", "price_nature", "region_scope", "region_code",
        "current_price", "availability",
    )
    return (
        pointers.join(listings, ["listing_id", "revision_id"])
        .join(matches, "revision_id")
        .join(t["channel"].select("channel_id", "code"), "channel_id")
        .join(facts, ["observation_id", "observed_at"])
    )
