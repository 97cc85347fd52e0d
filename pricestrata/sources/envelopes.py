"""JSON evidence envelopes of the malls: one stored response becomes one row per SKU."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricestrata.functions import vocab
from pricestrata.functions.device import (
    availability_by_brand,
    availability_from_flags,
    availability_from_inventory,
    with_category,
)
from pricestrata.functions.text import nfkc, normalize_text, plain, squeeze
from pricestrata.sources.pages import read_nodes

c = F.col

SNAPSHOTS = (
    "schema string, source_url string,"
    " snapshots array<struct<selections:map<string,string>,html:string>>"
)
DETAIL_BATCH = (
    "schema string, responses array<struct<spuId:string,skuId:string,seoTitle:string,price:string,"
    "original_price:string,bty_type:string,product_status:string,color:string,config:string,"
    "skuAttributes:map<string,string>,attributeList:array<struct<value:array<struct<key:string,"
    "`_$text1`:string,items:array<struct<skuId:string,attributes:map<string,string>>>>>>>>>"
)
DETAIL_MAP = (
    "schema string, commoditySpu struct<id:string,spuName:string>, specItem struct<"
    "specMainSeq:map<string,string>,specItemSeq:map<string,array<struct<name:string>>>,"
    "skuSpecList:array<struct<skuId:string,sequences:map<string,string>>>>,"
    "downSkuIds array<string>, zeroStoreSkuIds array<string>,"
    "details map<string,struct<salePrice:string,marketPrice:string,colorName:string,"
    "marketable:int,skuStatus:struct<hasStore:int>>>"
)
EMBEDDED = (
    "props struct<pageProps:struct<mainData:struct<current:struct<prdId:string,name:string,"
    "productOptions:struct<sbomList:map<string,struct<sbomCode:string,price:string,"
    "commingSoonFlag:int,inventory:int,gbomAttrList:array<struct<attrName:string,"
    "attrValue:string>>>>>>>>>"
)


def _opened(docs: DataFrame, body: str, schema: str, tag: str | None) -> DataFrame:
    """Parse a body column with a declared schema; wrong or foreign documents carry a reason."""
    opened = docs.withColumn("env", F.from_json(body, f"{schema}, _corrupt_record string"))
    torn = c("env").isNull() | c("env._corrupt_record").isNotNull()
    fault = F.when(torn, "EVIDENCE_NOT_JSON")
    if tag is not None:
        fault = fault.when(
            c("env.schema").isNull() | (c("env.schema") != tag), "SCHEMA_UNSUPPORTED"
        )
    return opened.withColumn("doc_error", fault)


def snapshot_rows(docs: DataFrame, tag: str, key: str = "doc_id") -> DataFrame:
    """Variant snapshots: one row per snapshot with its selections and markup."""
    opened = _opened(docs, "body", SNAPSHOTS, tag)
    empty = F.size(F.coalesce("env.snapshots", F.array())) == 0
    exploded = opened.withColumn(
        "doc_error", F.coalesce("doc_error", F.when(empty, "SNAPSHOTS_EMPTY"))
    ).select(
        *[n for n in docs.columns if n != "body"],
        "doc_error",
        c("env.source_url").alias("source_url"),
        F.posexplode_outer("env.snapshots").alias("snapshot_no", "snapshot"),
    )
    blank = F.exists(
        F.map_entries("snapshot.selections"),
        lambda e: (squeeze(e["key"]) == "") | (squeeze(F.coalesce(e["value"], F.lit(""))) == ""),
    )
    incomplete = c("snapshot.selections").isNull() | c("snapshot.html").isNull() | blank
    return exploded.select(
        *[n for n in exploded.columns if n not in ("snapshot", "doc_error")],
        c("snapshot.selections").alias("selections"),
        c("snapshot.html").alias("html"),
        F.coalesce("doc_error", F.when(incomplete, "SNAPSHOT_INVALID")).alias("error"),
    )


def snapshot_skus(rows: DataFrame, key: str = "doc_id", stock: str | None = None) -> DataFrame:
    """Name, SKU id, prices and stock wording of every snapshot fragment.

    ``stock`` is the class of the node that states the stock; without it the whole fragment does.
    """
    fragment = rows.withColumn("fragment", F.concat_ws("#", c(key).cast("string"), c("snapshot_no").cast("string")))
    nodes = read_nodes(
        fragment, "fragment", "html", ("h1", "h2", "del", "s", "section", "body"),
        ("product-name", "current-price", "sale-price", "original-price", "market-price", *([stock] if stock else [])),
    )
    klass = F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit(""))
    sku = F.try_element_at("attrs", F.lit("data-sku-id"))

    def first(condition: Column, value: Column) -> Column:
        return F.min(F.when(condition, F.struct("node_no", value.alias("v"))))["v"]

    original = c("tag").isin("del", "s") | klass.rlike("(original|market)-price")
    # One fragment describes one variant, so its few nodes reduce to one row.
    facts = nodes.withColumn("t", normalize_text(c("text"))).groupBy("fragment").agg(
        first(c("tag").isin("h1", "h2") | klass.rlike(r"(^| )product-name( |\z)"), c("t")).alias("name"),
        first(klass.rlike(r"(^| )(current|sale)-price( |\z)"), c("t")).alias("current_text"),
        first(original, c("t")).alias("original_text"),
        first(sku.isNotNull(), sku).alias("sku_id"),
        first(
            klass.rlike(rf"(^| ){stock}( |\z)") if stock else c("up_no") == -1, c("t")
        ).alias("page_text"),
    )
    return (
        fragment.drop("html")
        .join(facts, "fragment", "left")
        .withColumn("availability", availability_by_brand(c("brand"), F.coalesce("page_text", F.lit(""))))
        .drop("fragment", "page_text")
    )


def detail_batch_rows(docs: DataFrame, tag: str, key: str = "doc_id") -> DataFrame:
    """Detail batch: one row per response, with its labelled dimensions and coverage check."""
    opened = _opened(docs, "body", DETAIL_BATCH, tag)
    exploded = opened.select(
        key, "doc_error", F.posexplode_outer("env.responses").alias("response_no", "r")
    )
    groups = F.flatten(F.filter(F.transform("r.attributeList", lambda g: g["value"]), lambda v: v.isNotNull()))
    labels = F.filter(
        F.transform(
            groups, lambda e: F.struct(squeeze(e["key"]).alias("key"), squeeze(e["_$text1"]).alias("label"))
        ),
        lambda e: (e["key"] != "") & (e["label"] != ""),
    )
    offered = F.flatten(F.filter(F.transform(groups, lambda e: e["items"]), lambda v: v.isNotNull()))
    staged = exploded.withColumns({"labels": labels, "offered": offered})
    # Key/label pairs are short lists; the conflict check compares pairs with distinct keys.
    pairs = F.array_distinct("labels")
    keys = F.array_distinct(F.transform("labels", lambda e: e["key"]))
    varying = F.transform(
        F.filter("labels", lambda e: e["label"].isin(*vocab.VARIANT_LABELS)), lambda e: e["key"]
    )
    labelled = staged.withColumns(
        {
            "label_conflict": F.size(pairs) > F.size(keys),
            "fixed_keys": F.array_except(keys, varying),
            "label_map": F.when(F.size(pairs) == F.size(keys), F.map_from_entries(pairs)),
        }
    )
    selected = F.transform(
        F.map_entries("r.skuAttributes"),
        lambda e: F.struct(
            F.coalesce(F.try_element_at("label_map", e["key"]), e["key"]).alias("key"),
            squeeze(e["value"]).alias("value"),
        ),
    )
    reachable = F.transform(
        F.filter(
            "offered",
            lambda o: F.forall(
                "fixed_keys",
                lambda k: F.try_element_at(o["attributes"], k).eqNullSafe(
                    F.try_element_at(c("r.skuAttributes"), k)
                ),
            ),
        ),
        lambda o: squeeze(o["skuId"]),
    )
    sku = squeeze(c("r.skuId"))
    rows = labelled.select(
        key, "doc_error", "response_no", "label_conflict",
        squeeze(c("r.spuId")).alias("product_id"),
        sku.alias("sku_id"),
        squeeze(c("r.seoTitle")).alias("name"),
        c("r.price").alias("current_text"),
        c("r.original_price").alias("original_text"),
        c("r.color").alias("raw_color"),
        c("r.config").alias("raw_version"),
        F.concat_ws(" ", F.coalesce("r.bty_type", F.lit("")), F.coalesce("r.product_status", F.lit(""))).alias("stock_text"),
        selected.alias("selected"),
        F.array_distinct(F.array_append(F.coalesce(reachable, F.array().cast("array<string>")), sku)).alias("advertised"),
    )
    names = F.transform("selected", lambda e: e["key"])
    blank = F.exists("selected", lambda e: e["value"] == "")
    shaped = rows.withColumn(
        "row_error",
        F.when(c("doc_error").isNotNull(), c("doc_error"))
        .when(c("label_conflict"), "LABEL_CONFLICT")
        .when(blank | (F.size(F.array_distinct(names)) < F.size(names)), "DIMENSIONS_AMBIGUOUS")
        .when(~sku_ok(c("sku_id")), "SKU_INVALID"),
    ).withColumn("dimensions", F.when(c("row_error").isNull(), F.map_from_entries("selected")))
    return shaped.select(
        key, "response_no", "product_id", "sku_id", "name", "current_text", "original_text",
        "stock_text", "dimensions", "advertised",
        F.coalesce("raw_color", F.try_element_at("dimensions", F.lit("颜色"))).alias("color"),
        F.coalesce("raw_version", F.try_element_at("dimensions", F.lit("版本"))).alias("version"),
        "row_error",
    )


def sku_ok(sku: Column) -> Column:
    return F.coalesce(sku.rlike(r"^[0-9]+\z"), F.lit(False))


def detail_batch_coverage(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents with repeated SKUs or with advertised SKUs that no response returned."""
    returned = rows.groupBy(key, "sku_id").agg(F.count(F.lit(1)).alias("n"))
    wanted = rows.select(key, F.explode("advertised").alias("sku_id")).distinct()
    omitted = wanted.join(returned, [key, "sku_id"], "left_anti").groupBy(key).agg(
        F.count(F.lit(1)).alias("omitted")
    )
    return (
        returned.groupBy(key)
        .agg(F.count(F.lit(1)).alias("skus"), F.count_if(c("n") > 1).alias("repeated"))
        .join(omitted, key, "left")
        .select(
            key, "skus", "repeated", F.coalesce("omitted", F.lit(0)).cast("bigint").alias("omitted"),
            F.when(c("repeated") > 0, "SKU_REPEATED")
            .when(c("omitted") > 0, "SKU_COVERAGE_INCOMPLETE")
            .alias("error"),
        )
    )


def resolved_specs(docs: DataFrame, tag: str, key: str = "doc_id") -> DataFrame:
    """Spec sequences of a detail map resolved to option names; every dimension is required."""
    opened = _opened(docs, "body", DETAIL_MAP, tag)
    sku = opened.select(
        key, "doc_error",
        c("env.specItem.specMainSeq").alias("labels"),
        c("env.specItem.specItemSeq").alias("options"),
        F.inline_outer("env.specItem.skuSpecList"),
    )
    entries = F.transform(
        F.map_entries("sequences"),
        lambda e: F.struct(
            squeeze(F.try_element_at("labels", e["key"])).alias("key"),
            squeeze(
                F.get(
                    F.try_element_at("options", e["key"]), e["value"].try_cast("int") - 1
                )["name"]
            ).alias("value"),
        ),
    )
    same = F.array_sort(F.map_keys("sequences")) == F.array_sort(F.map_keys("labels"))
    staged = sku.withColumns({"entries": entries, "same": same}).withColumn(
        "names", F.transform("entries", lambda e: e["key"])
    )
    unresolved = F.exists(
        "entries",
        lambda e: (F.coalesce(e["key"], F.lit("")) == "") | (F.coalesce(e["value"], F.lit("")) == ""),
    )
    error = (
        F.when(c("doc_error").isNotNull(), c("doc_error"))
        .when(~F.coalesce("same", F.lit(False)), "SPEC_DIMENSIONS_MISSING")
        .when(
            unresolved
            | (F.size(F.array_distinct("names")) < F.size("names"))
            | (F.size("entries") == 0),
            "SPEC_UNRESOLVED",
        )
    )
    return staged.withColumn("error", error).select(
        key,
        squeeze(c("skuId")).alias("sku_id"),
        F.when(c("error").isNull(), F.map_from_entries("entries")).alias("dimensions"),
        "error",
    )


def detail_map_rows(docs: DataFrame, tag: str, key: str = "doc_id") -> DataFrame:
    """Detail map: one row per SKU with specs, prices and availability from flags.

    The detail map and the spec table must name the same SKUs; a document where they differ
    carries SKU_COVERAGE_INCOMPLETE on the rows of either side.
    """
    opened = _opened(docs, "body", DETAIL_MAP, tag)
    details = opened.select(
        key, c("env.commoditySpu.id").alias("product_id"), c("env.commoditySpu.spuName").alias("name"),
        c("env.downSkuIds").alias("down"), c("env.zeroStoreSkuIds").alias("zero"),
        F.explode("env.details").alias("raw_sku", "d"),
    ).withColumn("sku_id", squeeze(c("raw_sku")))
    specs = resolved_specs(docs, tag, key).withColumnRenamed("error", "spec_error")
    joined = details.join(specs, [key, "sku_id"], "full_outer")
    no_sku = F.array().cast("array<string>")
    state = availability_from_flags(
        F.array_contains(F.coalesce("down", no_sku), c("sku_id")),
        F.array_contains(F.coalesce("zero", no_sku), c("sku_id")),
        c("d.marketable"),
        c("d.skuStatus.hasStore"),
    )
    return joined.select(
        key, "sku_id", squeeze(c("product_id")).alias("product_id"), squeeze(c("name")).alias("name"),
        "dimensions", c("d.colorName").alias("shown_color"),
        c("d.salePrice").alias("current_text"),
        c("d.marketPrice").alias("original_text"),
        F.when(c("d").isNotNull(), state).alias("availability"),
        F.when(c("spec_error").isin("EVIDENCE_NOT_JSON", "SCHEMA_UNSUPPORTED"), c("spec_error"))
        .when(c("d").isNull() | (c("dimensions").isNull() & c("spec_error").isNull()), "SKU_COVERAGE_INCOMPLETE")
        .otherwise(c("spec_error"))
        .alias("error"),
    )


_SCRIPT = r"(?s)<script[^>]+id=[\"']__NEXT_DATA__[\"'][^>]*>(.*?)</script>"


def embedded_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """SKUs of the JSON block embedded in a product page, with their attribute maps."""
    body = docs.withColumn("block", F.regexp_extract("html", _SCRIPT, 1))
    opened = body.withColumn("env", F.from_json(F.when(c("block") != "", c("block")), EMBEDDED))
    current = "env.props.pageProps.mainData.current"
    sku = opened.select(
        key,
        F.when(c("block") == "", "EMBEDDED_DATA_MISSING")
        .when(c(f"{current}.productOptions.sbomList").isNull(), "SCHEMA_UNSUPPORTED")
        .alias("doc_error"),
        c(f"{current}.prdId").alias("product_id"),
        c(f"{current}.name").alias("raw_name"),
        F.explode_outer(c(f"{current}.productOptions.sbomList")).alias("slot", "s"),
    )
    pairs = F.transform(
        "s.gbomAttrList",
        lambda e: F.struct(
            squeeze(F.coalesce(e["attrName"], F.lit(""))).alias("key"),
            squeeze(F.coalesce(e["attrValue"], F.lit(""))).alias("value"),
        ),
    )
    staged = sku.withColumn("pairs", pairs).withColumn("names", F.transform("pairs", lambda e: e["key"]))
    broken = (
        c("pairs").isNull()
        | (F.size("pairs") == 0)
        | F.exists("pairs", lambda e: (e["key"] == "") | (e["value"] == ""))
        | (F.size(F.array_distinct("names")) < F.size("names"))
    )
    error = (
        F.when(c("doc_error").isNotNull(), c("doc_error"))
        .when(squeeze(F.coalesce("s.sbomCode", F.lit(""))) == "", "SKU_INVALID")
        .when(broken, "ATTRIBUTES_AMBIGUOUS")
    )
    return staged.withColumn("error", error).select(
        key, "product_id", normalize_text(c("raw_name")).alias("name"),
        squeeze(c("s.sbomCode")).alias("sku_id"),
        F.when(c("error").isNull(), F.map_from_entries("pairs")).alias("attributes"),
        c("s.price").alias("current_text"),
        availability_from_inventory(c("s.commingSoonFlag"), c("s.inventory")).alias("availability"),
        "error",
    )


def json_after_marker(html: Column, marker: str) -> Column:
    """The JSON value that follows ``marker:`` in page script, NULL when there is none."""

    @F.pandas_udf(StringType())
    def read(pages: pd.Series) -> pd.Series:
        decoder = json.JSONDecoder()

        def one(page: str) -> str | None:
            start = page.find(f"{marker}:")
            if start < 0:
                return None
            rest = page[start + len(marker) + 1 :].lstrip()
            try:
                return json.dumps(decoder.raw_decode(rest)[0], ensure_ascii=False)
            except json.JSONDecodeError:
                return None

        return pages.map(one, na_action="ignore")

    return read(html)


def walk_objects(docs: DataFrame, key: str, body: str, id_field: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every object at any depth that carries ``id_field``, in document order, as JSON text.

    A document that cannot be read, or holds no such object, gives one row with its error. ``carry``
    names text columns of the document that its rows keep.
    """
    kinds = dict(docs.dtypes)
    held = "".join(f", {n} {kinds[n]}" for n in carry)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def visit(value: object, found: list[str]) -> None:
            stack = [value]
            while stack:
                node = stack.pop()
                if isinstance(node, dict):
                    if id_field in node:
                        found.append(json.dumps(node, ensure_ascii=False))
                    stack.extend(reversed(list(node.values())))
                elif isinstance(node, list):
                    stack.extend(reversed(node))

        def table(rows: list[tuple]) -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=[key, "position", "object", "error", *carry])
            return made.astype({"position": "Int32"})

        for frame in frames:
            rows: list[tuple] = []
            for name, text, *more in zip(frame[key], frame[body], *[frame[n] for n in carry], strict=True):
                found: list[str] = []
                try:
                    visit(json.loads(text), found)
                except (TypeError, ValueError, RecursionError):
                    rows.append((name, None, None, "JSON_UNREADABLE", *more))
                    continue
                if not found:
                    rows.append((name, None, None, "DISCOVERY_EMPTY", *more))
                rows.extend((name, i, item, None, *more) for i, item in enumerate(found))
                if len(rows) >= 20_000:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)

    return docs.select(key, body, *carry).mapInPandas(
        run, f"{key} {kinds[key]}, position int, object string, error string{held}"
    )


def discovered_products(
    objects: DataFrame, brand: Column, id_field: str, name_fields: list[str], key: str = "doc_id"
) -> DataFrame:
    """Approved products of walked objects; the first object of every product wins.

    A document without an approved product keeps one row with its error and no product.
    """
    names = [F.get_json_object("object", f"$.{f}") for f in name_fields]
    # Steps with plain columns: an object is read once per field, and names are not read again in every rule.
    fields = plain(objects.select(
        key, "position", "error", brand.alias("brand"),
        squeeze(F.get_json_object("object", f"$.{id_field}")).alias("product_id"),
        *[n.alias(f"name_{i}") for i, n in enumerate(names)],
    ))
    shown = [c(f"name_{i}") for i in range(len(names))]
    named = plain(fields.withColumn("name", F.coalesce(*[F.when(n != "", n) for n in shown])))
    rows = plain(named.select(key, "position", "error", "brand", "product_id", nfkc(c("name")).alias("name")))
    judged = plain(with_category(rows, "category_code", c("brand"), c("name")))
    approved = F.coalesce(sku_ok(c("product_id")) & c("category_code").isNotNull(), F.lit(False))
    # Objects that are not approved fall into one group of their document, which becomes its
    # error row unless the document has an approved product.
    firsts = (
        judged.withColumn("product_id", F.when(approved, c("product_id")))
        .groupBy(key, "product_id")
        .agg(F.min(F.struct("position", "name", "category_code")).alias("first"), F.max("error").alias("error"))
    )
    # The products of one document. Documents are read once, so both kinds of rows come from one pass.
    good = c("product_id").isNotNull()
    any_good = F.coalesce(c(key).isNotNull() & F.max(good).over(Window.partitionBy(key)), F.lit(False))
    return firsts.withColumn("any_good", any_good).where(good | ~c("any_good")).select(
        key, "product_id", F.when(good, c("first.position")).alias("position"),
        F.when(good, squeeze(c("first.name"))).alias("name"),
        F.when(good, c("first.category_code")).alias("category_code"),
        F.when(~good, F.coalesce("error", F.lit("NO_APPROVED_PRODUCT"))).alias("error"),
    )
