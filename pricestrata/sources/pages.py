"""Page markup as rows: one Arrow pass turns HTML into nodes, the rest is DataFrame work."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import parser as html_parser
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.functions import vocab
from pricestrata.functions.identity import source_day_utc
from pricestrata.functions.money import strict_price
from pricestrata.functions.text import compact, normalize_text, strip
from pricestrata.functions.urls import (
    absolute,
    host,
    page_parts,
    path,
    raw_pairs,
    resolved,
    single_value,
    values_of,
)
from pricestrata.session import dealt
from pricestrata.sources.seeds import regions

c = F.col
# HTML elements without an end tag (fixed values).
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_FLUSH = 20_000
NODE_FIELDS = "node_no int, up_no int, tag string, attrs map<string,string>, text string"


class _NodeReader(HTMLParser):
    """Collects wanted nodes with their nearest wanted ancestor and their whole text."""

    def __init__(self, tags: frozenset[str], classes: frozenset[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.classes = tags, classes
        self.nodes: list[list] = []
        self.stack: list[tuple[str, int, list[str], list[str]]] = [("", -1, [], [])]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = {k: v or "" for k, v in attrs}
        number = self.stack[-1][1]
        if tag in self.tags or not self.classes.isdisjoint(values.get("class", "").split()):
            self.nodes.append([len(self.nodes), number, tag, values, ""])
            number = len(self.nodes) - 1
        if tag not in _VOID:
            self.stack.append((tag, number, [], []))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close()

    def handle_endtag(self, tag: str) -> None:
        if any(frame[0] == tag for frame in self.stack[1:]):
            while self._close() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.stack[-1][2].append(data.strip())

    def _close(self) -> str:
        tag, number, own, below = self.stack.pop()
        text = " ".join([*own, *below])
        if text:
            self.stack[-1][3].append(text)
        if number != self.stack[-1][1]:
            self.nodes[number][4] = text
        return tag

    def read(self, html: str) -> list[list]:
        self.feed(html)
        self.close()
        while len(self.stack) > 1:
            self._close()
        return self.nodes


def read_nodes(
    df: DataFrame, key: str, html: str, tags: tuple[str, ...], classes: tuple[str, ...] = ()
) -> DataFrame:
    """One row per wanted node: (key, node_no, up_no, tag, attrs, text)."""
    wanted, marked = frozenset(tags), frozenset(classes)
    key_type = dict(df.dtypes)[key]
    schema = pa.schema(
        [
            ("node_no", pa.int32()), ("up_no", pa.int32()), ("tag", pa.string()),
            ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list = []
            rows: list[list] = []
            for i, page in enumerate(batch.column(1)):
                if page.is_valid:
                    nodes = _NodeReader(wanted, marked).read(page.as_py())
                    rows.extend(nodes)
                    keys.extend([i] * len(nodes))
                if len(rows) >= _FLUSH:
                    yield _pack(batch, keys, rows)
                    keys, rows = [], []
            if rows:
                yield _pack(batch, keys, rows)

    def _pack(batch: pa.RecordBatch, keys: list, rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        arrays = [
            pa.array(list(map(list, (d.items() for d in v))) if f.name == "attrs" else v, f.type)
            for f, v in zip(schema, columns, strict=True)
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keys, pa.int32())), *arrays],
            names=[key, *schema.names],
        )

    return df.select(key, html).mapInArrow(scan, f"{key} {key_type}, {NODE_FIELDS}")


def links(df: DataFrame, key: str, html: str, page_url: Column) -> DataFrame:
    """Anchors of a page in order with their absolute address and normalised text."""
    nodes = read_nodes(df, key, html, ("a",))
    pages = df.select(key, page_url.alias("page_url"))
    href = F.try_element_at("attrs", F.lit("href"))
    return (
        nodes.where(F.coalesce(href, F.lit("")) != "")
        .join(pages, key)
        .select(
            key,
            c("node_no").alias("position"),
            strip(href).alias("href"),
            absolute(c("page_url"), href).alias("url"),
            normalize_text(c("text")).alias("link_text"),
        )
    )


def first_links(found: DataFrame, key: list[str], product: Column, approved: Column) -> DataFrame:
    """Approved product links, the first one of every product wins."""
    names = [n for n in found.columns if n not in (*key, "position")]
    kept = found.where(approved).withColumn("product_id", product)
    packed = F.struct("position", F.struct(*names).alias("row"))
    return (
        kept.groupBy(*key, "product_id")
        .agg(F.min(packed).alias("first"))
        .select(
            *key, "product_id", c("first.position").alias("position"),
            *[c("first.row")[n].alias(n) for n in names],
        )
    )


class _TableReader(HTMLParser):
    """Tables of a page as [id, rows]; a row is its cells, a cell its text and link targets."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list] = []
        self.open: list[list] = []
        self.cell: list | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        values = dict(attrs)
        if tag == "table":
            table = [values.get("id"), []]
            self.tables.append(table)
            self.open.append(table)
        elif tag == "tr" and self.open:
            self.open[-1][1].append([])
            self.cell = None
        elif tag in ("td", "th") and self.open and self.open[-1][1]:
            self.cell = ["", []]
            self.open[-1][1][-1].append(self.cell)
        elif tag == "a" and self.cell is not None:
            self.cell[1].append((values.get("href") or "").strip())

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        if tag in ("td", "th", "tr", "table"):
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None and data.strip():
            self.cell[0] += f" {data.strip()}"


# Markup that needs no recovery: text, then a cell of mere text, a tag whose attribute values are simple, an element
# of raw text without markup in it, or a comment. Whatever else begins with "<" is caught by the last group.
_SPACE = r"[ \t\n\r\f]"
_VALUE = r"""=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`/]+)"""
_ATTRIBUTES = rf"(?:{_SPACE}++[a-zA-Z_:][-a-zA-Z0-9_:.]*+(?:{_VALUE})?)*+{_SPACE}*+"
_PLAIN = re.compile(
    rf"([^<]*+)(?:<([tT][dDhH])(?:{_ATTRIBUTES})>([^<]*+)</\2{_SPACE}*>"
    rf"|<(/?)(?!script|style|title|textarea)([a-zA-Z][a-zA-Z0-9]*+)({_ATTRIBUTES})>"
    rf"|<(script|style|title|textarea){_ATTRIBUTES}>([^<]*+)</\7{_SPACE}*>|<!--[^<>-]*(?:-[^<>-]+)*-->|(<)|\Z)"
)
_PAIRS = re.compile(rf"{_SPACE}([a-zA-Z_:][-a-zA-Z0-9_:.]*)({_VALUE})?")
# Elements whose content is not read as markup, by this parser or by a later one.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
_attribute_text = getattr(html_parser, "_unescape_attrvalue", unescape)


def _decoded(text: str, read=unescape) -> str:
    """Text with its character references resolved; where all are ampersands, without the standard pattern."""
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else read(text)


def _attribute(attrs: str, name: str) -> str | None:
    """The last value of an attribute in markup that ``_PLAIN`` accepts."""
    found = None
    for key, value in _PAIRS.findall(attrs):
        if key.lower() == name:
            found = (value[2:-1] if value[1] in "\"'" else value[1:]) if value else None
    return _decoded(found, _attribute_text) if found else found


def _plain_tables(page: str) -> list[list] | None:
    """What ``_TableReader`` gives for a page of plain markup; None where only the parser can tell."""
    tables: list[list] = []
    opened: list[list] = []
    rows: list[list] | None = None  # those of the table that is open
    cell: list | None = None
    for text, whole, inside, closing, tag, attrs, raw, content, other in _PLAIN.findall(page):
        if cell is not None and text:
            data = _decoded(text).strip()
            if data:
                cell[0] += f" {data}"
        if whole:
            data = _decoded(inside).strip()
            if rows:
                rows[-1].append([f" {data}" if data else "", []])
            elif cell is not None and data:
                cell[0] += f" {data}"
            cell = None
        elif tag:
            tag = tag.lower()
            if closing:
                if attrs and not attrs.isspace():
                    return None
                if tag in ("td", "th", "tr"):
                    cell = None
                elif tag == "table":
                    cell = None
                    if opened:
                        opened.pop()
                    rows = opened[-1][1] if opened else None
            elif tag in ("td", "th"):
                if rows:
                    cell = ["", []]
                    rows[-1].append(cell)
            elif tag == "tr":
                if rows is not None:
                    rows.append([])
                    cell = None
            elif tag == "a":
                if cell is not None:
                    cell[1].append((_attribute(attrs, "href") or "").strip())
            elif tag == "table":
                rows = []
                opened.append([_attribute(attrs, "id"), rows])
                tables.append(opened[-1])
            elif tag in _RAW:
                return None
        elif raw:
            if cell is not None:
                data = (content if raw in ("script", "style") else unescape(content)).strip()
                if data:
                    cell[0] += f" {data}"
        elif other:
            return None
    return tables


def page_tables(page: str) -> list[list]:
    """Tables of a page; the parser is asked where markup is not plain, as it is many times slower."""
    found = _plain_tables(page)
    if found is None:
        reader = _TableReader()
        reader.feed(page)
        reader.close()
        found = reader.tables
    return found


_TABLES = (
    "array<struct<id:string,rows:array<struct<cells:array<struct<text:string,"
    "links:array<string>>>>>>>"
)


def _pack_tables(pages: list[list[list]]) -> pa.Array:
    """Tables of pages as one nested array, level by level."""
    by_page, by_table, by_row, by_cell = [0], [0], [0], [0]
    ids: list = []
    texts: list[str] = []
    links: list[str] = []
    for tables in pages:
        for name, rows in tables:
            ids.append(name)
            for cells in rows:
                for text, targets in cells:
                    texts.append(text)
                    if targets:
                        links.extend(targets)
                    by_cell.append(len(links))
                by_row.append(len(texts))
            by_table.append(len(by_row) - 1)
        by_page.append(len(ids))

    def lists(offsets: list[int], values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    def strings(values: list) -> pa.Array:
        return pa.array(values, pa.string())

    cells = pa.StructArray.from_arrays([strings(texts), lists(by_cell, strings(links))], ["text", "links"])
    rows = pa.StructArray.from_arrays([lists(by_row, cells)], ["cells"])
    return lists(by_page, pa.StructArray.from_arrays([strings(ids), lists(by_table, rows)], ["id", "rows"]))


def read_tables(df: DataFrame, html: str) -> DataFrame:
    """The rows with the tables of their page, a nested column as large as the page, in its place.

    All other columns go through the reader, so that nothing has to be joined back to it.
    """
    carried = [n for n in df.columns if n != html]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [page_tables(page or "") for page in part.column(len(carried)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], _pack_tables(found)], names=[*carried, "tables"]
                )

    kinds = dict(df.dtypes)
    schema = "".join(f"{n} {kinds[n]}, " for n in carried)
    return df.select(*carried, html).mapInArrow(scan, f"{schema}tables {_TABLES}")


def market_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of wholesale market pages with their own fault and the first fault of their page.

    ``docs`` has the key, html, page_url, commodity_id and source_date. Only the table reader
    runs in Python; structure, region, price, market and duplicate rules are expressions. One
    bad row fails its whole page, and a page is a single document, so the page-level windows
    see no more rows than the page held. Documents without a key give no rows; where several
    have one key, its rows are repeated.
    """
    facts = docs.where(c(key).isNotNull()).select(key, "page_url", "commodity_id", "source_date", "html")
    scanned = read_tables(facts, "html").withColumn(
        "tables", F.filter("tables", lambda t: t["id"] == "goaler")
    )
    rows = F.get("tables", F.lit(0))["rows"]
    headers = F.transform(F.get("rows", F.lit(0))["cells"], lambda x: compact(x["text"]))
    shaped = scanned.withColumn("rows", rows).withColumn(
        "page_error",
        F.when(F.size("tables") != 1, "DATASET_STRUCTURE_CHANGED")
        .when(F.size("rows") < 2, "DATASET_EMPTY")
        .when(
            ~F.coalesce(headers == F.array(*map(F.lit, vocab.MARKET_HEADERS)), F.lit(False)),
            "DATASET_STRUCTURE_CHANGED",
        ),
    )
    body = F.when(c("page_error").isNull(), F.slice("rows", 2, F.size("rows")))
    # The address of a page is taken apart once, not for each of its rows.
    parts = {n: c(f"page_{n}") for n in page_parts(c("page_url"))}
    exploded = shaped.withColumn("body", body).withColumns(
        {f"page_{n}": x for n, x in page_parts(c("page_url")).items()}
    ).select(
        key, "page_url", "commodity_id", "source_date", "page_error", *parts.values(),
        F.posexplode_outer("body").alias("row_no", "r"),
    )

    def cell(i: int) -> Column:
        return F.get("r.cells", F.lit(i))

    charts = F.filter(cell(5)["links"], lambda h: F.contains(h, F.lit("seachline.fhtml")))
    fields = exploded.withColumns(
        {
            "region_name": compact(cell(0)["text"]),
            "market_name": compact(cell(1)["text"]),
            "price_text": compact(cell(2)["text"]),
            "charts": charts,
        }
    ).withColumn("href", strip(F.get("charts", F.lit(0)))).withColumn(
        "chart", resolved(c("page_url"), parts, c("href"))
    ).withColumn("pairs", raw_pairs(c("chart"))).withColumn("markets", values_of(c("pairs"), "enterid"))
    known = fields.withColumns(
        {
            "price": strict_price(c("price_text")),
            "market_id": single_value(c("markets"), r"^[1-9][0-9]*\z"),
            "chart_ok": (host(c("chart")) == "cif.mofcom.gov.cn")
            & (path(c("chart")) == "/cif/seachline.fhtml")
            & (values_of(c("pairs"), "commdityid") == F.array("commodity_id"))
            & (values_of(c("pairs"), "Edate") == F.array(c("source_date").cast("string"))),
        }
    ).join(F.broadcast(regions(docs.sparkSession)), "region_name", "left")
    chart_bad = (F.size("charts") != 1) | ~c("chart_ok") | c("market_id").isNull()
    own = known.withColumn(
        "row_error",
        F.when(c("page_error").isNotNull(), c("page_error"))
        .when(F.size("r.cells") != len(vocab.MARKET_HEADERS), "DATASET_STRUCTURE_CHANGED")
        .when(c("region_code").isNull(), "REGION_MAPPING_MISSING")
        .when(c("market_name") == "", "MARKET_IDENTITY_INVALID")
        .when(c("price").isNull(), "PRICE_VALUE_INVALID")
        .when(F.coalesce(chart_bad, F.lit(True)), "MARKET_IDENTITY_INVALID"),
    ).select(
        key, "row_no", "source_date", "commodity_id", "market_id", "market_name", "region_code",
        "price", "price_text", "row_error",
    )
    market = Window.partitionBy(key, "market_id").orderBy("row_no")
    cell_of = Window.partitionBy(key, "market_id", "region_code").orderBy("row_no")
    again = F.row_number().over(Window.partitionBy(key, "row_no").orderBy(F.lit(1))) > 1
    repeated = again | (F.row_number().over(cell_of) > 1)
    renamed = F.first("market_name").over(market) != c("market_name")
    page = Window.partitionBy(key)
    fault = F.when(c("row_error").isNotNull(), F.struct("row_no", "row_error"))
    # Rows are short and their identity costs much: parts are not merged by their bytes.
    return (
        dealt(own, key)
        .withColumns({"repeated": repeated, "renamed": renamed})
        .withColumn(
            "row_error",
            F.coalesce(
                c("row_error"),
                F.when(c("repeated"), "DATASET_DUPLICATE_ROW"),
                F.when(c("renamed"), "MARKET_IDENTITY_INVALID"),
            ),
        )
        .withColumn("doc_error", F.min(fault).over(page)["row_error"])
        .drop("repeated", "renamed")
    )


def market_documents(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Faulty pages with their first fault."""
    return (
        rows.where(c("doc_error").isNotNull())
        .groupBy(key)
        .agg(F.first("doc_error").alias("error_code"))
    )


def market_candidates(rows: DataFrame) -> DataFrame:
    """Rows of faultless pages with the instant their source day began."""
    return rows.where(c("doc_error").isNull()).drop("row_error", "doc_error").withColumn(
        "observed_at", source_day_utc(c("source_date"))
    )


def priced_anchors(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """SKU links that carry a price: current, original, dimensions and the stock text around them."""
    # Class names of the source pages (fixed values).
    nodes = read_nodes(
        docs, key, "html", ("a", "h1", "del", "s"),
        ("item", "current_price", "original_price", "original-price", "previous_price",
         "dimensionCapacity", "dimensionColor", "dimensionMemory", "dimensionScreensize"),
    )
    klass = F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit(""))
    t = normalize_text(c("text"))
    link = c("tag") == "a"
    is_original = klass.rlike(
        r"(^| )(original_price|original-price|previous_price)( |\z)"
    ) | c("tag").isin("del", "s")
    is_current = klass.rlike(r"(^| )current_price( |\z)")
    dimension = F.regexp_extract(klass, r"(?:^| )dimension([A-Za-z]+)", 1)
    none = F.lit(None)
    # Each node goes into the group of its link and, for its text, into one of its own, so that
    # the pages are read once.
    part = F.struct(
        F.when(link, c("node_no")).otherwise(c("up_no")).alias("anchor_no"),
        F.when(link, c("up_no")).alias("item_no"),
        none.cast("int").alias("own_no"), none.cast("string").alias("item_text"),
        F.when(link, F.try_element_at("attrs", F.lit("href"))).alias("href"),
        F.when(is_current, F.struct("node_no", t.alias("t"))).alias("current"),
        F.when(is_original, F.struct("node_no", t.alias("t"), "tag", klass.alias("klass"))).alias("original"),
        F.when(dimension != "", F.struct(F.lower(dimension).alias("key"), t.alias("value"))).alias("entry"),
    )
    whole = F.struct(
        none.cast("int").alias("anchor_no"), c("node_no").alias("item_no"), c("node_no").alias("own_no"),
        t.alias("item_text"), none.cast("string").alias("href"),
        none.cast("struct<node_no:int,t:string>").alias("current"),
        none.cast("struct<node_no:int,t:string,tag:string,klass:string>").alias("original"),
        none.cast("struct<key:string,value:string>").alias("entry"),
    )
    # One group per link: the link itself, its prices and its few dimension labels.
    groups = nodes.select(key, F.inline(F.array(part, whole))).groupBy(key, "anchor_no", "own_no").agg(
        F.max("href").alias("href"),
        F.max("item_no").alias("item_no"),
        F.max("item_text").alias("own_text"),
        F.min("current").alias("current"),
        F.min("original").alias("original"),
        F.map_from_entries(F.array_sort(F.collect_set("entry"))).alias("dimensions"),
    )
    # The links of an item and the item itself: a part of one page.
    item = F.max("own_text").over(Window.partitionBy(key, "item_no"))
    parts = groups.withColumn("item_text", F.when(c("item_no").isNotNull(), item)).where(
        c("href").isNotNull()
    )
    crossed = c("original.tag").isin("del", "s") | c("original.klass").rlike("previous|strikethrough|crossed")
    part_number = F.regexp_extract(path(c("url")), r"^(.*)/([A-Za-z0-9]+)/[aA]/?\z", 2)
    joined = (
        parts.join(docs.select(key, "page_url"), key)
        .withColumn("url", absolute(c("page_url"), c("href")))
        .withColumn("part_number", F.when(
            (F.lower(F.regexp_replace(path(c("url")), r"/[^/]+/[aA]/?\z", "")) == F.lower(path(c("page_url"))))
            & (part_number != ""), F.concat(F.upper(part_number), F.lit("/A"))))
    )
    has_price = c("current").isNotNull()
    has_dims = F.size(F.coalesce("dimensions", F.create_map().cast("map<string,string>"))) > 0
    error = F.when(c("part_number").isNotNull() & (has_price != has_dims), "SKU_INCOMPLETE").when(
        has_price & has_dims & c("part_number").isNull(), "SKU_OUTSIDE_PRODUCT"
    )
    out_of_stock = c("item_text").rlike("|".join(vocab.AVAILABILITY_TERMS["APPLE"][0][1]))
    return joined.where((has_price & has_dims) | error.isNotNull()).select(
        key, "part_number", "url", "dimensions",
        c("current.t").alias("current_text"),
        c("original.t").alias("original_text"),
        F.when(c("original").isNotNull(), F.when(crossed, "划线原价").otherwise("原价")).alias("original_label"),
        F.when(out_of_stock, "OUT_OF_STOCK").otherwise("ON_SALE").alias("availability"),
        error.alias("error"),
    )
