"""Comparison SQL shared by several queries (written for the comparison engine only)."""

from pricestrata.bind import ctes

ADAPTER = "events-1"
POLICY = "catalog-price-policy-1"

# Exact HALF_UP price per base unit as text, from cents and millionths.
_MICROS = (
    "(2 * CAST(current_price * 100 AS HUGEINT) * 10000000000"
    " + CAST(base_quantity_value * 1000000 AS HUGEINT))"
    " // (2 * CAST(base_quantity_value * 1000000 AS HUGEINT))"
)


def micros_decimal(expr: str) -> str:
    return (
        f"CAST(CAST(({expr}) // 1000000 AS VARCHAR) || '.' ||"
        f" lpad(CAST(({expr}) % 1000000 AS VARCHAR), 6, '0') AS DECIMAL(20,6))"
    )


GATE = f"""
placed AS (
  SELECT * REPLACE (coalesce(region_scope, 'UNKNOWN') AS region_scope,
                    CASE WHEN region_scope IS NULL THEN 'UNKNOWN' ELSE region_code END
                        AS region_code),
         date_trunc('millisecond', ts) AS observed_at,
         pricing_basis IN ('PACKAGE_TOTAL', 'UNIT_QUOTED') AND current_price IS NOT NULL
           AND base_quantity_value IS NOT NULL AND base_unit IS NOT NULL AS derivable
  FROM candidates),
derived AS (
  SELECT *, CASE WHEN derivable THEN {micros_decimal(_MICROS)} END AS want_price,
         CASE WHEN derivable AND length(base_unit) <= 8 THEN 'CNY_PER_' || base_unit END AS want_unit
  FROM placed),
filled AS (
  SELECT * REPLACE (coalesce(unit_price, CASE WHEN want_unit IS NOT NULL THEN want_price END)
                      AS unit_price,
                    CASE WHEN unit_price IS NULL AND want_unit IS NOT NULL THEN want_unit
                         ELSE unit_price_unit END AS unit_price_unit,
                    rejection_code AS rejection_code),
         unit_price AS given_price
  FROM derived),
judged AS (
  SELECT *,
    CASE
      WHEN rejection_code IS NOT NULL THEN rejection_code
      WHEN price_type = 'AVAILABILITY_ONLY' THEN
        CASE WHEN region_scope = 'UNKNOWN' THEN 'REGION_UNKNOWN'
             WHEN price_nature != 'RETAIL_OFFER' THEN 'AVAILABILITY_NATURE_UNTRUSTED'
             WHEN availability NOT IN ('OFF_SHELF', 'OUT_OF_STOCK', 'COMING_SOON')
               THEN 'AVAILABILITY_STATE_UNTRUSTED'
             WHEN coalesce(CAST(current_price AS VARCHAR), CAST(original_price AS VARCHAR),
                           CAST(unit_price AS VARCHAR), unit_price_unit) IS NOT NULL
               THEN 'AVAILABILITY_AMOUNT_PRESENT'
             WHEN pricing_basis != 'UNKNOWN' OR fee_status != 'NOT_APPLICABLE'
                  OR promotion_label IS NOT NULL THEN 'AVAILABILITY_PRICING_TERMS_PRESENT' END
      WHEN current_price IS NULL THEN 'CURRENT_PRICE_MISSING'
      WHEN region_scope = 'UNKNOWN' THEN 'REGION_UNKNOWN'
      WHEN price_nature = 'UNKNOWN' THEN 'PRICE_NATURE_UNKNOWN'
      WHEN pricing_basis NOT IN ('PACKAGE_TOTAL', 'UNIT_QUOTED') THEN 'PRICING_BASIS_UNTRUSTED'
      WHEN pricing_basis = 'UNIT_QUOTED' AND unit_price IS NULL THEN 'UNIT_PRICE_MISSING'
      WHEN given_price IS NOT NULL AND want_price IS NOT NULL
           AND (given_price != want_price OR (want_unit IS NOT NULL
                AND unit_price_unit IS DISTINCT FROM want_unit)) THEN 'UNIT_PRICE_MISMATCH'
      WHEN price_nature LIKE '%OFFER' THEN
        CASE WHEN price_type != 'DIRECT_UNCONDITIONAL' THEN 'CONDITIONAL_PRICE'
             WHEN fee_status NOT IN ('ITEM_ONLY', 'SEPARATE_FEES_EXCLUDED')
               THEN 'FEE_SEMANTICS_UNTRUSTED'
             WHEN price_nature = 'RETAIL_OFFER' AND original_price < current_price
               THEN 'ORIGINAL_BELOW_CURRENT' END
      ELSE
        CASE WHEN price_type != 'PUBLISHED_VALUE' THEN 'MARKET_VALUE_UNPUBLISHED'
             WHEN fee_status != 'NOT_APPLICABLE' THEN 'MARKET_FEE_SEMANTICS_INVALID' END
    END AS reason
  FROM filled),
gated AS (
  SELECT * REPLACE (reason AS rejection_code),
         CASE WHEN reason IS NULL THEN 'ACCEPTED' ELSE 'REJECTED' END AS quality_status
  FROM judged)"""

_PARTS = (
    "currency", "original_price", "original_price_type", "current_price", "price_nature",
    "price_type", "pricing_basis", "promotion_label", "availability", "unit_price",
    "unit_price_unit", "fee_status", "quality_status", "rejection_code", "displayed_price_text",
)
PAYLOAD = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in _PARTS) + " || '|'"

FACTS = GATE + f""",
hashed AS (SELECT *, sha256({PAYLOAD}) AS payload_hash FROM gated),
facts AS (
  SELECT *, CAST(observed_at AS DATE) AS observed_date,
         sha256(listing_id || '|' || revision_id || '|' || region_scope || '|' || region_code
           || '|' || strftime(observed_at, '%Y-%m-%dT%H:%M:%S.%g') || '|' || source_hash || '|'
           || payload_hash || '|{ADAPTER}|{POLICY}') AS observation_key
  FROM hashed),
accepted AS (SELECT * FROM facts WHERE quality_status = 'ACCEPTED'),
trusted AS (
  SELECT listing_id, revision_id, max(observed_at) AS trusted_at FROM accepted GROUP BY ALL),
chosen AS (
  SELECT listing_id, min(revision_id) AS revision_id, max(trusted_at) AS trusted_at,
         count(*) > 1 AS conflict
  FROM (SELECT *, max(trusted_at) OVER (PARTITION BY listing_id) AS top FROM trusted)
  WHERE trusted_at = top GROUP BY listing_id)"""


def gated(extra: str = "") -> str:
    return ctes("candidates", extra=GATE + (f",\n{extra}" if extra else ""))


def facts(*views: str, extra: str = "") -> str:
    return ctes("candidates", *views, extra=FACTS + (f",\n{extra}" if extra else ""))
