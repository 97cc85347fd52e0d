"""Source parsers of the malls and of the city sheet: evidence documents in, listing rows out.

Documents are rows of the evidence source (see ``evidence_source``). A product page fails as a whole:
the first fault of its SKUs, in page order, is the ``doc_error`` of the one row that it gives. A faultless page
gives a row per SKU with everything that identity rules and the price gate read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.functions import device, vocab
from pricestrata.functions.identity import canonical_json, json_hash, sorted_map
from pricestrata.functions.money import MONEY
from pricestrata.functions.text import normalize_text, plain, squeeze, with_normalized_entries
from pricestrata.functions.urls import host
from pricestrata.session import settle
from pricestrata.sources import envelopes, pages, sheets
from pricestrata.sources.seeds import city_commodities

c = F.col
# Formats and constants of the sources (fixed values).
SNAPSHOT_TAG = "device-price-browser-snapshots-v1"
OPPO_TAG = "oppo-oapi-detail-batch-v2"
VIVO_TAG = "vivo-api-detail-batch-v2"
CITY_TAG = "city-sheet-cells-1"
EMBEDDED_HOST = "item.vmall.com"
VERSION_LABELS = {"HUAWEI": ("配置", "版本", "规格", "容量"), "VIVO": ("版本", "规格", "容量")}
MERCHANTS = {
    "APPLE": "Apple 中国大陆官方在线商店", "HUAWEI": "华为中国大陆官方商城", "XIAOMI": "小米中国大陆官方商城",
    "OPPO": "OPPO 中国大陆官方商城", "VIVO": "vivo 中国大陆官方商城",
}
PRICE_LABELS = {
    "APPLE": ("Apple 原价", "Apple 当前售价"), "HUAWEI": ("华为商城划线原价", "华为商城当前售价"),
    "XIAOMI": ("小米商城划线原价", "小米商城当前售价"), "OPPO": ("OPPO 商城划线原价", "OPPO 商城当前售价"),
    "VIVO": ("vivo 商城划线原价", "vivo 商城当前售价"),
}
CITY_CHANNEL = "SHANGHAI_FRESH_RETAIL"
CITY_REGION = "310100"
CITY_SHEET = (
    "schema string, source_date string,"
    " cells array<struct<row:int,col:int,value:string,format:string>>"
)
SKU = (
    "doc_id", "sku_no", "found_product", "sku_id", "name", "version", "color", "dimensions", "current_text",
    "original_text", "original_label", "availability", "error",
)


def _none() -> Column:
    return F.lit(None).cast("string")


def _first(dimensions: Column, labels: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_element_at(dimensions, F.lit(x)) for x in labels])


def _is(docs: DataFrame, tag: str) -> Column:
    """Whether a document is, or may be a torn, envelope of this kind."""
    return F.coalesce(F.get_json_object("body", "$.schema") == tag, F.lit(False))


def _snapshots(docs: DataFrame, brand: str, stock: str | None = None) -> DataFrame:
    """SKU rows of rendered variants; selections are the dimensions."""
    rows = envelopes.snapshot_rows(docs.select("doc_id", "body", F.lit(brand).alias("brand")), SNAPSHOT_TAG)
    found = envelopes.snapshot_skus(rows, stock=stock)
    pick = lambda name: squeeze(F.try_element_at("selections", F.lit(name)))
    return found.select(
        "doc_id", F.coalesce("snapshot_no", F.lit(0)).alias("sku_no"), _none().alias("found_product"),
        squeeze(c("sku_id")).alias("sku_id"), "name", pick("version").alias("version"), pick("color").alias("color"),
        c("selections").alias("dimensions"), "current_text", "original_text",
        F.when(c("original_text").isNotNull(), PRICE_LABELS[brand][0]).alias("original_label"), "availability",
        F.coalesce("error", F.when(c("name").isNull(), "NAME_MISSING")).alias("error"),
    )


def oppo(docs: DataFrame) -> DataFrame:
    rendered = _is(docs, SNAPSHOT_TAG)
    # Written once: the coverage of a document is taken from its rows, twice.
    rows = settle(envelopes.detail_batch_rows(docs.where(~rendered), OPPO_TAG), "responses")
    gaps = envelopes.detail_batch_coverage(rows.where(c("row_error").isNull())).select("doc_id", c("error").alias("gap"))
    state = device.availability_from_text("OPPO", c("stock_text"))
    batch = rows.join(gaps, "doc_id", "left").select(
        "doc_id", F.coalesce("response_no", F.lit(0)).alias("sku_no"), c("product_id").alias("found_product"), "sku_id",
        "name", "version", "color", "dimensions", "current_text", "original_text",
        F.when(c("original_text").isNotNull(), PRICE_LABELS["OPPO"][0]).alias("original_label"),
        state.alias("availability"), F.coalesce("row_error", "gap").alias("error"),
    )
    return batch.unionByName(_snapshots(docs.where(rendered), "OPPO"))


def vivo(docs: DataFrame) -> DataFrame:
    rendered = _is(docs, SNAPSHOT_TAG)
    rows = envelopes.detail_map_rows(docs.where(~rendered), VIVO_TAG)
    order = Window.partitionBy("doc_id").orderBy(F.length("sku_id"), "sku_id")
    spec = rows.select(
        "doc_id", (F.row_number().over(order) - 1).alias("sku_no"), c("product_id").alias("found_product"), "sku_id",
        "name", _first(c("dimensions"), VERSION_LABELS["VIVO"]).alias("version"),
        F.coalesce(F.try_element_at("dimensions", F.lit("颜色")), "shown_color").alias("color"), "dimensions",
        "current_text", "original_text",
        F.when(c("original_text").isNotNull(), PRICE_LABELS["VIVO"][0]).alias("original_label"),
        "availability", "error",
    )
    return spec.unionByName(_snapshots(docs.where(rendered), "VIVO"))


def huawei(docs: DataFrame) -> DataFrame:
    page = F.coalesce(F.lower(host(c("page_url"))) == EMBEDDED_HOST, F.lit(False))
    rows = envelopes.embedded_rows(docs.where(page).select("doc_id", c("body").alias("html")))
    order = Window.partitionBy("doc_id").orderBy("sku_id")
    embedded = rows.select(
        "doc_id", (F.row_number().over(order) - 1).alias("sku_no"), c("product_id").alias("found_product"), "sku_id",
        "name", _first(c("attributes"), VERSION_LABELS["HUAWEI"]).alias("version"),
        F.try_element_at("attributes", F.lit("颜色")).alias("color"), c("attributes").alias("dimensions"),
        "current_text", _none().alias("original_text"), _none().alias("original_label"), "availability", "error",
    )
    return embedded.unionByName(_snapshots(docs.where(~page), "HUAWEI"))


def xiaomi(docs: DataFrame) -> DataFrame:
    """No SKU ids: a variant is its specification, and its stock stands in a box of its own."""
    rows = _snapshots(docs, "XIAOMI", stock="address-box").withColumn("sku_id", _none())
    colourless = F.coalesce("color", F.lit("")) == ""
    return rows.withColumn("error", F.coalesce("error", F.when(colourless, "COLOR_MISSING")))


def apple(docs: DataFrame) -> DataFrame:
    page = docs.select("doc_id", "page_url", c("body").alias("html"))
    heading = F.regexp_replace(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]*>", "")
    name = F.regexp_replace(normalize_text(heading), r"^购买\s*", "")
    rows = pages.priced_anchors(page).join(page.select("doc_id", name.alias("name")), "doc_id")
    order = Window.partitionBy("doc_id").orderBy("part_number")
    return rows.select(
        "doc_id", (F.row_number().over(order) - 1).alias("sku_no"), _none().alias("found_product"),
        c("part_number").alias("sku_id"), F.when(c("name") != "", c("name")).alias("name"),
        _none().alias("version"), F.try_element_at("dimensions", F.lit("color")).alias("color"),
        F.transform_keys("dimensions", lambda k, _: F.lower(k)).alias("dimensions"),
        "current_text", "original_text", "original_label", "availability",
        F.coalesce("error", F.when(c("name") == "", "NAME_MISSING")).alias("error"),
    )


def _specification(brand: str) -> tuple[dict[str, Column], Column]:
    """(specification fields, attributes that remain) of an SKU row."""
    fields, rest = device.map_dimensions(brand, c("dimensions"))
    parts = device.split_version(F.coalesce("version", F.lit("")), brand)
    if brand != "APPLE":
        fields["color"] = c("color")
        fields |= {"memory": parts["memory"], "capacity": parts["capacity"]}
    if brand in ("OPPO", "VIVO"):
        fields["edition"] = c("version")
    if brand == "VIVO":
        for name, label in (("memory", "内存"), ("capacity", "容量")):
            fields[name] = F.coalesce(fields[name], F.try_element_at("dimensions", F.lit(label)))
    if brand == "XIAOMI":
        fields["edition"] = parts["edition"]
    if brand == "APPLE":
        fields["manufacturer_part_number"] = c("sku_id")
    return fields, rest


def product_listings(brand: str, channel: str, skus: DataFrame, docs: DataFrame) -> DataFrame:
    """Listing rows of faultless documents; one row with its ``doc_error`` of each other document."""
    facts = docs.select(
        "doc_id", "product_id", c("category_code").alias("wanted"), "page_url", "body_hash", "observed_at"
    )
    rows = facts.join(skus.select(*SKU), "doc_id", "left")
    # A pattern by name exists for all brands but one, whose categories come from its addresses.
    if brand in vocab.NAME_RULES:
        rows = device.with_category(rows, "found", F.lit(brand), c("name"))
    else:
        rows = rows.withColumn("found", c("wanted"))
    original, current = PRICE_LABELS[brand]
    rows = device.with_price_candidate(
        rows, "p", c("current_text"), c("original_text"), F.coalesce("original_label", F.lit(original)),
        F.lit(current), c("availability"),
    )
    rows = plain(rows.withColumn("key", F.coalesce("sku_id", canonical_json(sorted_map(c("dimensions"))))))
    own = F.when(c("sku_no").isNull(), "NO_SKU").otherwise(
        F.coalesce(
            c("error"),
            F.when(c("found_product") != c("product_id"), "PRODUCT_DIFFERS"),
            F.when(~c("found").eqNullSafe(c("wanted")), "CATEGORY_DIFFERS"),
            F.when(c("copies") > 1, "SKU_REPEATED"),
            F.when(c("names") > 1, "NAMES_DIFFER"),
        )
    )
    # Windows over one document, whose SKUs fit in a task. A page is read SKU by SKU, so a repeat or another
    # name is the fault of the later SKU; prices are read when all SKUs are known.
    whole = Window.partitionBy("doc_id")
    placed = Window.partitionBy("doc_id").orderBy("place")
    rows = rows.withColumn("place", F.coalesce("sku_no", F.lit(0))).withColumns({
        "copies": F.row_number().over(Window.partitionBy("doc_id", "key").orderBy("place")),
        "names": F.when(c("name") != F.first("name").over(placed), 2).otherwise(1),
    })
    rows = rows.withColumns({"own": own, "late": own.isNull()}).withColumn("own", F.coalesce("own", "p.error"))
    fault = F.when(c("own").isNotNull(), F.struct("late", "place", "own"))
    rows = rows.withColumn("doc_error", F.min(fault).over(whole)["own"])
    rows = rows.withColumn("first", c("place") == F.min("place").over(whole)).where("doc_error IS NULL OR first")
    fields, rest = _specification(brand)
    rows = plain(rows.withColumns({f"f_{n}": x for n, x in fields.items()}).withColumn("spec_attributes", rest))
    fields = {n: c(f"f_{n}") for n in fields}
    rows = with_normalized_entries(rows, "spec_attributes", "entries")
    rows = plain(device.with_specification(rows, "s", fields, c("entries")))
    good = c("doc_error").isNull()
    none = _none()
    return rows.select(
        c("doc_id").alias("record_id"),
        (F.shiftleft(c("doc_id").cast("bigint"), 20) + F.coalesce("sku_no", F.lit(0))).alias("ingest_seq"),
        F.lit(channel).alias("channel"), F.lit(brand).alias("brand_code"), F.lit(channel).alias("merchant_key"),
        F.lit(MERCHANTS[brand]).alias("market_name"),
        F.lit("BRAND_OFFICIAL").alias("seller_type"), F.lit("VERIFIED").alias("verification_status"),
        F.when(good, device.listing_key(c("product_id"), c("sku_id"), c("s.json"))).alias("listing_key"),
        c("wanted").alias("category_code"), c("product_id").alias("external_product_id"),
        F.when(good, c("sku_id")).alias("external_sku_id"),
        F.create_map(*[x for n in vocab.SPEC_FIELDS for x in (F.lit(n), fields.get(n, none))]).alias("spec_fields"),
        "spec_attributes",
        F.lit("NATIONAL").alias("region_scope"), F.lit("CN").alias("region_code"), F.lit("CNY").alias("currency"),
        F.lit("RETAIL_OFFER").alias("price_nature"),
        c("p.current_price").alias("current_price"), c("p.original_price").alias("original_price"),
        c("p.original_price_type").alias("original_price_type"), c("p.price_type").alias("price_type"),
        c("p.pricing_basis").alias("pricing_basis"), "availability", c("p.fee_status").alias("fee_status"),
        none.alias("promotion_label"), c("p.displayed_price_text").alias("displayed_price_text"),
        F.lit(None).cast("decimal(20,6)").alias("unit_price"), none.alias("unit_price_unit"),
        none.alias("rejection_code"), c("body_hash").alias("source_hash"), "observed_at",
        device.display_title(c("name"), c("version"), c("color"), c("sku_id")).alias("title"), "doc_error",
    )


def city_listings(docs: DataFrame) -> DataFrame:
    """The whitelisted commodities of faultless sheets, and one row of each other sheet."""
    env = F.from_json("body", f"{CITY_SHEET}, _corrupt_record string")
    opened = docs.withColumn("env", env).withColumn(
        "torn",
        F.when(c("env").isNull() | c("env._corrupt_record").isNotNull(), "EVIDENCE_NOT_JSON")
        .when(~c("env.schema").eqNullSafe(F.lit(CITY_TAG)), "SCHEMA_UNSUPPORTED")
        .when(~c("env.source_date").eqNullSafe(c("source_date")), "SOURCE_DATE_MISMATCH"),
    )
    cells = opened.where(c("torn").isNull()).select("doc_id", F.inline("env.cells")).select(
        "doc_id", c("row").alias("row_no"), c("col").alias("col_no"), "value", c("format").alias("number_format")
    )
    prices = sheets.sheet_prices(cells)
    known = F.broadcast(city_commodities(docs.sparkSession))
    held = opened.select("doc_id", "source_date", "observed_at", "torn")
    rows = held.join(prices, "doc_id", "left").join(known, "commodity_code", "left")
    error = F.coalesce("torn", F.when(c("commodity_code").isNull(), "DATASET_EMPTY"), "error_code")
    first = F.coalesce("commodity_code", F.lit("")) == F.min(F.coalesce("commodity_code", F.lit(""))).over(
        Window.partitionBy("doc_id")
    )
    rows = rows.withColumns({"doc_error": error, "first": first}).where(c("doc_error").isNull() | c("first"))
    shown = c("price").cast("string")
    pairs = {
        "commodity_code": c("commodity_code"), "commodity_name": c("commodity_name"),
        "commodity_group": c("commodity_group"), "source_specification": c("specification"),
        "quoted_unit": c("unit"), "net_content": F.lit("500克"), "time_precision": F.lit("DAY"),
    }
    number = reduce(
        lambda case, i: case.when(c("commodity_code") == vocab.CITY_COMMODITIES[i][0], i),
        range(1, len(vocab.CITY_COMMODITIES)), F.when(c("commodity_code") == vocab.CITY_COMMODITIES[0][0], 0),
    ).otherwise(0)
    none = _none()
    return rows.select(
        c("doc_id").alias("record_id"),
        (F.shiftleft(c("doc_id").cast("bigint"), 20) + number).alias("ingest_seq"),
        F.lit(CITY_CHANNEL).alias("channel"), F.lit("shanghai-fresh-price-monitoring").alias("merchant_key"),
        F.lit("上海市主要主副食品价格监测").alias("market_name"),
        F.when(
            c("doc_error").isNull(),
            F.concat_ws(":", F.lit("shanghai-city-retail-average"), "commodity_code", "specification", "unit"),
        ).alias("listing_key"),
        F.lit("FRESH_MONITORED_COMMODITY").alias("category_code"),
        F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)]).alias("source_attributes"),
        F.lit("CITY").alias("region_scope"), F.lit(CITY_REGION).alias("region_code"), F.lit("CNY").alias("currency"),
        F.lit("RETAIL_AVERAGE").alias("price_nature"), c("price").cast(MONEY).alias("current_price"),
        F.lit(None).cast(MONEY).alias("original_price"), F.lit("NONE").alias("original_price_type"),
        F.lit("PUBLISHED_VALUE").alias("price_type"), F.lit("UNIT_QUOTED").alias("pricing_basis"),
        F.lit("UNKNOWN").alias("availability"), F.lit("NOT_APPLICABLE").alias("fee_status"),
        none.alias("promotion_label"), F.concat(shown, F.lit("元/500克")).alias("displayed_price_text"),
        F.lit(None).cast("decimal(20,6)").alias("unit_price"), none.alias("unit_price_unit"),
        none.alias("rejection_code"),
        json_hash(
            F.lit(CITY_CHANNEL), c("source_date"), c("commodity_code"), c("commodity_group"), c("commodity_name"),
            c("specification"), c("unit"), F.lit(CITY_REGION), shown,
        ).alias("source_hash"),
        "observed_at", "doc_error",
    )


# Channel -> (brand, reader of its SKUs).
MALLS = {
    "APPLE_CN_WEB": ("APPLE", apple), "HUAWEI_CN_WEB": ("HUAWEI", huawei), "XIAOMI_CN_WEB": ("XIAOMI", xiaomi),
    "OPPO_CN_WEB": ("OPPO", oppo), "VIVO_CN_WEB": ("VIVO", vivo),
}


def mall_parser(channel: str):
    brand, read = MALLS[channel]
    return lambda docs: product_listings(brand, channel, read(docs), docs)
