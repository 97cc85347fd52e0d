"""Plans that must not hold a whole table in one place, on a few rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.functions import vocab
from pricestrata.plans import batch, commits, replay
from pricestrata.queries import load
from pricestrata.sources import envelopes, evidence, evidence_source, malls, pages, sheets

SF_DIR = "/root/testdata/sf0.001"
_HEAD = "".join(f"<td>{h}</td>" for h in vocab.MARKET_HEADERS)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _page(market: int) -> str:
    link = f'<a href="seachline.fhtml?enterid={market}&amp;commdityid=5&amp;Edate=2024-03-01">x</a>'
    row = f"<tr><td>海南省</td><td>市场</td><td>8.50</td><td>1</td><td>2</td><td>{link}</td></tr>"
    return f'<table id="goaler"><tr>{_HEAD}</tr>{row}</table>'


def _pages(spark, rows: list[tuple]):
    df = spark.createDataFrame(rows, "doc_id bigint, html string")
    return df.withColumns({
        "page_url": F.lit("https://cif.mofcom.gov.cn/cif/seach.fhtml?commdityid=5"),
        "commodity_id": F.lit("5"), "source_date": F.lit("2024-03-01").cast("date"),
    })


def test_market_pages_are_joined_with_regions_only(spark):
    """Pages went through the table reader and were joined back to themselves, as a broadcast where they looked small."""
    docs = _pages(spark, [(1, _page(7))])
    assert _plan(pages.market_rows(docs)).count("Join ") == 1


def test_market_pages_keep_faults_of_repeated_and_missing_keys(spark):
    rows = pages.market_rows(_pages(spark, [(1, _page(7)), (2, _page(7)), (2, _page(8)), (None, _page(7)), (3, None)]))
    assert {r.doc_id: r.error_code for r in pages.market_documents(rows).collect()} == {
        2: "DATASET_DUPLICATE_ROW", 3: "DATASET_STRUCTURE_CHANGED"
    }
    assert [(r.doc_id, r.market_id) for r in pages.market_candidates(rows).collect()] == [(1, "7")]


def test_batches_of_pages_are_joined_with_fixed_values_only(spark, tmp_path):
    """All pages were broadcast on the way to every output of a document batch and of a commit."""
    commodity = vocab.WHOLESALE_COMMODITIES[0][1]
    docs = spark.createDataFrame(
        [(i, commodity, _page(m).replace("commdityid=5", f"commdityid={commodity}")) for i, m in ((1, 7), (2, 7), (3, 8))],
        "doc_id bigint, commodity_id string, html string",
    ).withColumns({
        "page_url": F.lit("https://cif.mofcom.gov.cn/cif/seach.fhtml"), "source_date": F.lit("2024-03-01").cast("date"),
    })
    rows = batch.judge_documents(batch.parse(batch.MARKET_CHANNEL, docs))
    assert _plan(rows).count("Join ") == 3  # regions, commodities, categories
    root, judged = str(tmp_path / "store"), batch.settle(rows, "judged")
    assert commits.apply_batch(spark, root, "a", judged, "a") and not commits.apply_batch(spark, root, "a", judged, "a")
    assert [commits.read(spark, root, n).count() for n in ("observation", "listing", "current", "rejected")] == [2, 2, 2, 0]


def test_documents_are_made_of_dealt_rows(spark):
    """A table in one file with one row group was one task of all page work."""
    load()
    made = bind.dealt_frame(spark, SF_DIR, "market_pages", "orders", "o_orderkey", "o_custkey", "o_orderdate")
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_discovery_reads_documents_once_and_joins_nothing(spark):
    """Documents were read three times, and joined to their brands and to the ids of good ones."""
    body = '{"list":[{"prdId":"1","prdName":"HUAWEI Mate 60"},{"prdId":"x","prdName":"HUAWEI Mate 60"}]}'
    docs = spark.createDataFrame(
        [(1, "HUAWEI", body), (2, "HUAWEI", "{"), (3, "HUAWEI", "{}"), (4, "VIVO", body), (5, None, body)],
        "doc_id bigint, brand string, body string",
    )
    objects = envelopes.walk_objects(docs, "doc_id", "body", "prdId", ("brand",))
    found = envelopes.discovered_products(objects, F.col("brand"), "prdId", ["prdName", "briefName"])
    assert "Join" not in _plan(found) and _plan(found).count("MapInPandas") == 1
    assert sorted((r.doc_id, r.product_id, r.position, r.error) for r in found.collect()) == [
        (1, "1", 0, None), (2, None, None, "JSON_UNREADABLE"), (3, None, None, "DISCOVERY_EMPTY"),
        (4, None, None, "NO_APPROVED_PRODUCT"), (5, None, None, "NO_APPROVED_PRODUCT"),
    ]


def test_sheets_are_shuffled_by_sheet_once(spark):
    """Cells were shuffled for labels, columns and faults, and sheets times commodities joined to what they state."""
    label = [(1, i, 0, name, None) for i, name in enumerate(vocab.SHEET_LABELS, 1)]
    entry = vocab.CITY_COMMODITIES[0]
    cells = [(1, i, 2, v, "0.00_ ") for i, v in enumerate([*entry[1:5], "3.25"], 1)]
    frame = spark.createDataFrame(
        [*label, *cells, (2, 1, 1, "x", None)], "doc_id bigint, row_no int, col_no int, value string, number_format string"
    )
    found = sheets.sheet_prices(frame)
    assert "Join" not in _plan(found)
    rows = {(r.doc_id, r.commodity_code): r for r in found.collect()}
    assert len(rows) == 2 * len(vocab.CITY_COMMODITIES)
    assert (rows[1, entry[0]].matches, str(rows[1, entry[0]].price), rows[1, entry[0]].row_error) == (1, "3.25", None)
    assert rows[1, entry[0]].error_code == "COMMODITY_MAPPING_MISSING"
    assert {r.error_code for k, r in rows.items() if k[0] == 2} == {"DATASET_STRUCTURE_CHANGED"}


def test_absences_match_by_row_and_never_by_null(spark):
    """Facts and manifests were shuffled by all their ids, with the hashes that only the record needs."""
    records = spark.range(1, 4).select(
        F.col("id").alias("record_id"), F.lit(404).alias("http_status"), F.lit("SUCCEEDED").alias("validation_status"),
        F.lit("SKIPPED").alias("parse_status"), *[F.lit("u").alias(n) for n in ("request_url", "final_url", "unit_url")],
        F.lit("h").alias("raw_hash"), F.lit("2024-02-01").cast("timestamp_ntz").alias("fetched_at"),
    )
    promised = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, None), (3, 1, 1)], "record_id bigint, listing_id int, revision_id int")
    facts = spark.createDataFrame([(1, 1, 1), (2, 1, None), (3, 1, 2)], promised.schema).withColumns({
        "price_type": F.lit("AVAILABILITY_ONLY"), "availability": F.lit("OFF_SHELF"), "quality_status": F.lit("ACCEPTED"),
        "current_price": F.lit(None).cast("decimal(18,2)"), "original_price": F.lit(None).cast("decimal(18,2)"),
        "source_hash": F.lit("h"), "observed_at": F.lit("2024-02-01").cast("timestamp_ntz"),
    })
    found = replay.check_absences(records, facts, promised)
    assert "FullOuter" not in _plan(found)
    assert {r.record_id: r.consistent for r in found.collect()} == {1: True, 2: False, 3: False}


def test_files_of_a_channel_are_dealt_over_folders(spark, tmp_path):
    """All files of a channel were in one folder, whose writers waited for each other."""
    docs = spark.range(50).select(
        F.col("id").alias("record_id"), F.lit("X").alias("channel"), F.lit("1").alias("product_id"), F.lit("PHONE").alias("category_code"),
        F.lit("u").alias("page_url"), F.lit("2024-03-05").alias("source_date"),
        F.lit("2024-03-05").cast("timestamp_ntz").alias("observed_at"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("body"),
    )
    evidence.store(docs, str(tmp_path))
    assert len([x for x in (tmp_path / "files" / "X").iterdir() if x.is_dir()]) > 25
    found = evidence_source.read(spark, str(tmp_path), "X").select("doc_id", "body", "fault").collect()
    assert {tuple(r) for r in found} == {(i, f"b{i}", None) for i in range(50)}


def test_responses_are_parsed_once(spark):
    """The coverage of a document parsed its responses again, for what came back and for what was advertised."""
    body = f'{{"schema":"{malls.OPPO_TAG}","responses":[{{"spuId":"1","skuId":"7","seoTitle":"OPPO","price":"5"}}]}}'
    found = malls.oppo(spark.createDataFrame([(1, body), (2, "{")], "doc_id bigint, body string"))
    assert "responses" not in _plan(found)
    assert {(r.doc_id, r.sku_id, r.error) for r in found.collect()} == {(1, "7", None), (2, None, "EVIDENCE_NOT_JSON")}


def test_plain_pages_do_without_the_parser_and_give_what_it_gives():
    """Every page went through the parser, tag by tag, which took most of a batch."""
    def parsed(html: str) -> list:
        reader = pages._TableReader()
        reader.feed(html)
        reader.close()
        return reader.tables

    assert pages._plain_tables(_page(7)) == parsed(_page(7)) and pages._plain_tables(_page(7)) is not None
    plain = [
        "", "a &lt; b", "<table ID=goaler><TR><td class='x'> 1&nbsp;</TD><th>2<b>3</b>4</th></tr></table><td>5</td>",
        "<table><tr><td>1<table id=''><td>2</td><tr><td>3</td></table>4<td>5</table>6", "<tr><td>1</td></tr>",
        """<!-- a-b --><table id><tr><td>x<a href=" q?a=1&amp;b=2&copy=3 " href="'v'">y</a><a href='"q'><a>z<!-- <b --></td></tr>""",
        "<script>x = 1</script><table><tr><td><style>td {}</style>&amp;<title>a&amp;b</title></td ></tr>",
    ]
    odd = [
        "<table><tr><td>1 < 2</td></tr>", "<table><tr><td/>x</td><td", "<script>if (a<b) x</script>", "<table id='a'id='b'>",
        "<table><tr><td>x</td y=1>z</tr>", "<table><tr><td><?pi?>x<xmp><td></xmp>", "<table><tr><td a = 'x'>1",
    ]
    for html in plain + odd:
        assert pages.page_tables(html) == parsed(html), html
        assert html not in odd or pages._plain_tables(html) is None, html
    assert sum(pages._plain_tables(html) is not None for html in plain) >= 6


def test_tables_of_pages_keep_their_levels(spark):
    rows = spark.createDataFrame([(1, "<table id=a><tr></tr><tr><td>x<a href=u>y</a></td></tr></table><table>"), (2, None), (3, "x")], "k int, html string")
    got = {r.k: [(t.id, [[(x.text, x.links) for x in row.cells] for row in t.rows]) for t in r.tables] for r in pages.read_tables(rows, "html").collect()}
    assert got == {1: [("a", [[], [(" x y", ["u"])]]), (None, [])], 2: [], 3: []}


def test_page_addresses_are_taken_apart_once(spark):
    """Every row of a page took the address of its page apart again, and its link once for each parameter."""
    plan = _plan(pages.market_rows(_pages(spark, [(1, _page(7))])))
    assert "page_origin" in plan.split("Generate")[1]


def test_page_rows_are_not_merged_into_few_tasks(spark):
    """Rows of pages are few bytes, so that the tasks that judge them were merged down to about one a core."""
    rows = pages.market_rows(_pages(spark, [(1, _page(7))]))
    assert "REPARTITION_BY_NUM" in rows._jdf.queryExecution().executedPlan().toString()
