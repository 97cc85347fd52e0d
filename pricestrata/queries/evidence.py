"""Evidence extraction over pages, and over pages and envelopes derived from orders and parts."""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata import bind
from pricestrata.bind import ctes, pick
from pricestrata.checks import stored
from pricestrata.functions import vocab
from pricestrata.functions.identity import canonical_json, sorted_map
from pricestrata.queries import query
from pricestrata.queries.devices import BRANDS4, _sql_category
from pricestrata.queries.scalars import sql_map, sql_squeeze
from pricestrata.session import shared_folder, spread
from pricestrata.sources import envelopes, evidence, pages, sheets

c = F.col
TAG = "evidence-1"


@query(
    "unpacked_evidence",
    "SRC-02",
    """SELECT 'doc/' || CAST(doc_id AS VARCHAR) || '.gz' AS relative_path,
         CASE WHEN doc_id % 23 NOT IN (5, 6) THEN sha256(text) END AS body_hash,
         CASE WHEN doc_id % 23 NOT IN (5, 6) THEN CAST(octet_length(encode(text)) AS BIGINT) END AS size,
         CASE WHEN doc_id % 23 = 5 THEN 'FILE_MISSING' WHEN doc_id % 23 = 6 THEN 'BODY_UNREADABLE'
           WHEN doc_id % 9 = 4 THEN 'HASH_MISMATCH' END AS fault FROM documents""",
)
def unpacked_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as gzip files in the shared folder, some missing, torn or unlike their hash."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = [gzip.compress(t.encode(), 1)[: 9 if torn else None] for t, torn in zip(frame["text"], frame["torn"], strict=True)]
            yield pd.DataFrame({"relative_path": frame["relative_path"], "content": packed})

    docs = bind.frame(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc/"), c("doc_id").cast("string"), F.lit(".gz")).alias("relative_path"), "text"
    )
    packed = docs.where(c("doc_id") % 23 != 5).select(
        "relative_path", "text", (c("doc_id") % 23 == 6).alias("torn")
    ).mapInPandas(pack, "relative_path string, content binary")
    folder = shared_folder(spark, "evidence")
    evidence.write_files(packed, folder)
    files = evidence.read_files(spark, folder)
    digest = F.sha2(c("text").cast("binary"), 256)
    expected = docs.select(
        c("doc_id").alias("record_id"), "relative_path",
        F.when(c("doc_id") % 9 == 4, F.reverse(digest)).otherwise(F.upper(digest)).alias("digest"),
    )
    return evidence.verify(evidence.unpack(files), expected).select(
        "relative_path", "body_hash", "size", "fault"
    )


_STORED_SQL = """
WITH own AS (SELECT doc_id, 'doc/' || CAST(doc_id AS VARCHAR) || '.gz' AS path, sha256(text) AS digest,
    CAST(octet_length(encode(text)) AS BIGINT) AS size, coalesce(lang = 'en', false) AS asked FROM documents),
r AS (SELECT doc_id, path, CASE WHEN doc_id % 9 = 4 THEN reverse(digest) WHEN doc_id % 41 = 5 THEN upper(digest) ELSE digest END
      AS digest, size + CASE WHEN doc_id % 13 = 2 THEN 1 ELSE 0 END AS size, asked FROM own
  UNION ALL SELECT doc_id, 'doc/' || CAST(doc_id - 1 AS VARCHAR) || '.gz', digest, size, false FROM own WHERE doc_id % 31 = 3
  UNION ALL SELECT doc_id, '../' || path, digest, size, true FROM own WHERE doc_id % 37 = 1),
p AS (SELECT path, count(*) AS n, min(digest) AS digest, min(digest) <> max(digest) OR min(size) <> max(size) AS disagree,
    bool_and(regexp_full_match(digest, '[0-9a-f]{64}')) AS hex, min(size) AS size, bool_or(asked) AS asked FROM r GROUP BY 1),
f AS (SELECT path, digest AS body, size AS length, doc_id % 23 = 6 AS torn, doc_id % 17 = 8 AND doc_id % 23 <> 6 AS blank FROM own WHERE doc_id % 23 <> 5
  UNION ALL SELECT 'stray/' || path, digest, size, false, false FROM own WHERE doc_id % 29 = 7),
m AS (SELECT coalesce(p.path, f.path) AS relative_path, n, asked, body, torn, f.path IS NOT NULL AS stored, digest, size, length,
    CASE WHEN n IS NULL THEN 'FILE_EXTRA' WHEN p.path LIKE '../%' THEN 'PATH_ESCAPES' WHEN NOT hex THEN 'HASH_MALFORMED'
      WHEN disagree THEN 'REFERENCES_DISAGREE' WHEN f.path IS NULL THEN 'FILE_MISSING' WHEN blank THEN 'FILE_EMPTY' END AS early
  FROM p FULL JOIN f ON f.path = p.path),
faults AS (SELECT relative_path, coalesce(n, 0) AS n_records, stored, CASE WHEN early IS NULL AND asked AND NOT torn THEN body END
    AS body_hash, coalesce(early, CASE WHEN asked AND torn THEN 'BODY_UNREADABLE' WHEN asked AND body <> digest THEN 'HASH_MISMATCH'
      WHEN asked AND length <> size THEN 'SIZE_MISMATCH' END) AS fault FROM m)
"""


def _stored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """References of records and the faults of the files below a folder: some are missing, torn, empty, unlike their hash
    or size, named by two records or by none. Bodies of English documents are read."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = [
                b"" if kind == "blank" else gzip.compress(t.encode(), 1)[: 9 if kind == "torn" else None]
                for t, kind in zip(frame["text"], frame["kind"], strict=True)
            ]
            yield pd.DataFrame({"relative_path": frame["relative_path"], "content": packed})

    k, name = c("doc_id"), F.concat(F.lit("doc/"), c("doc_id").cast("string"), F.lit(".gz"))
    docs = bind.frame(spark, sf_dir, "documents").select("doc_id", name.alias("relative_path"), "text", "lang")
    kind = F.when(k % 23 == 6, "torn").when(k % 17 == 8, "blank")
    stray = docs.where(k % 29 == 7).withColumns({
        "relative_path": F.concat(F.lit("stray/"), "relative_path"), "kind": F.lit(None).cast("string")
    })
    folder = shared_folder(spark, "stored")
    files = docs.where(k % 23 != 5).withColumn("kind", kind).unionByName(stray)
    evidence.write_files(files.mapInPandas(pack, "relative_path string, content binary"), folder)

    own = docs.select(
        k.alias("record_id"), "relative_path", F.sha2(c("text").cast("binary"), 256).alias("digest"),
        F.octet_length("text").cast("bigint").alias("size"), F.coalesce(c("lang") == "en", F.lit(False)).alias("asked"),
    )
    r = c("record_id")
    wrong = F.when(r % 9 == 4, F.reverse("digest")).when(r % 41 == 5, F.upper("digest")).otherwise(c("digest"))
    other = F.concat(F.lit("doc/"), (r - 1).cast("string"), F.lit(".gz"))
    references = (
        own.withColumns({"digest": wrong, "size": c("size") + F.when(r % 13 == 2, 1).otherwise(0)})
        .unionByName(own.where(r % 31 == 3).withColumns({"relative_path": other, "asked": F.lit(False)}))
        .unionByName(own.where(r % 37 == 1).withColumns({
            "relative_path": F.concat(F.lit("../"), "relative_path"), "asked": F.lit(True)
        }))
    )
    return references, stored.file_faults(references, folder)


@query("stored_file_faults", "AUD-17 SRC-02", _STORED_SQL + "SELECT * FROM faults")
def stored_file_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir)[1]


@query(
    "records_with_file_faults",
    "AUD-17",
    _STORED_SQL + """SELECT DISTINCT doc_id AS record_id FROM r JOIN faults ON relative_path = path
                     WHERE fault IS NOT NULL AND n_records > 0""",
)
def records_with_file_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored.records_with_file_faults(*_stored(spark, sf_dir))


_ANCHORS = """
raw AS (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hrefs FROM pages),
a AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS position FROM raw),
b AS (SELECT page_id, CAST(position AS INTEGER) AS position, href,
    regexp_extract(url, '^[a-z]+://[^/]+') || href AS url, lower(substr(href, 2)) AS product_id FROM a WHERE href LIKE '/%'
    AND href != '')"""


@query(
    "page_links",
    "SRC-08",
    "WITH " + _ANCHORS + " SELECT page_id, position, href, url FROM b",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(bind.frame(spark, sf_dir, "pages"))
    return (
        pages.links(rows, "page_id", "html", c("url"))
        .where(c("href").startswith("/"))
        .select("page_id", "position", "href", "url")
    )


@query(
    "first_page_products",
    "WIN-12 SRC-08",
    "WITH " + _ANCHORS + """ SELECT page_id, product_id, min(position) AS position, arg_min(href, position) AS href
       FROM b WHERE regexp_full_match(product_id, '[a-z]+') GROUP BY 1, 2""",
)
def first_page_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.links(spread(bind.frame(spark, sf_dir, "pages")), "page_id", "html", c("url"))
    product = F.lower(F.expr("substring(href, 2)"))
    approved = c("href").startswith("/") & product.rlike(r"^[a-z]+\z")
    return pages.first_links(found, ["page_id"], product, approved).select(
        "page_id", "product_id", "position", "href"
    )


_COMMODITIES = [row[1] for row in vocab.WHOLESALE_COMMODITIES]
_HEAD = "".join(f"<td>{h}</td>" for h in vocab.MARKET_HEADERS)
# Orders as wholesale market pages of one to three rows; remainders of the key inject faults.
bind.VIEWS["market_pages"] = (
    "SELECT doc_id, commodity_id, source_date, 'https://cif.mofcom.gov.cn/cif/seach.fhtml?commdityid=' || commodity_id AS page_url, "
    "n_rows, region, market_id, price1, price2, "
    "'<html><body><a href=\"/cif/x\">top</a><table id=\"' || CASE WHEN doc_id % 31 = 4 THEN 'other' ELSE 'goaler' END || '\"><tr>' || "
    f"CASE WHEN doc_id % 37 = 5 THEN '<td>地区</td>' ELSE '{_HEAD}' END || '</tr>' || "
    "CASE WHEN doc_id % 61 = 11 THEN '' ELSE "
    "'<tr><td> ' || region || '</td><td>市场 A</td><td>' || price1 || '</td><td>1</td><td>2</td><td><a href=\"seachline.fhtml?enterid=' || market_id || '&amp;commdityid=' || commodity_id || '&amp;Edate=' || CAST(source_date AS STRING) || '\">图</a></td></tr>' || "
    "CASE WHEN n_rows > 1 THEN '<tr><td>' || CASE WHEN doc_id % 47 = 8 THEN '火星' WHEN doc_id % 53 = 9 THEN region ELSE '海南省' END || '</td><td>市场' || CASE WHEN doc_id % 67 = 12 THEN 'B' ELSE 'A' END || '</td><td>' || price2 || '</td><td>1</td><td>2</td>' || CASE WHEN doc_id % 41 = 6 THEN '' ELSE '<td><a href=\"seachline.fhtml?enterid=' || market_id || '&amp;commdityid=' || CASE WHEN doc_id % 59 = 10 THEN '9' ELSE commodity_id END || '&amp;Edate=' || CAST(source_date AS STRING) || '\">图</a></td>' END || '</tr>' ELSE '' END || "
    "CASE WHEN n_rows > 2 THEN '<tr><td>广东省</td><td>市场C</td><td>7.00</td><td>1</td><td>2</td><td><a href=\"seachline.fhtml?enterid=77&amp;commdityid=' || commodity_id || '&amp;Edate=' || CAST(source_date AS STRING) || '\">图</a></td></tr>' ELSE '' END END || "
    "'</table></body></html>' AS html FROM ("
    "SELECT o_orderkey AS doc_id, " + pick("o_custkey", _COMMODITIES) + " AS commodity_id, CAST(o_orderdate AS DATE) AS source_date, "
    "1 + o_orderkey % 3 AS n_rows, " + pick("o_custkey", [r for r in vocab.REGION_CODES if r not in ("海南省", "广东省")]) + " AS region, "
    "CAST(1000 + o_custkey % 50 AS STRING) AS market_id, "
    "CAST(CAST(o_custkey % 90 + 1 AS DECIMAL(8,2)) AS STRING) AS price1, "
    "CASE WHEN o_orderkey % 43 = 7 THEN '0.00' ELSE CAST(o_orderkey % 70 + 1 AS STRING) || '.5' END AS price2 FROM {orders}) x"
)
_MARKET_ERROR = """
judged AS (SELECT *, CASE WHEN doc_id % 31 = 4 THEN 'DATASET_STRUCTURE_CHANGED'
    WHEN doc_id % 61 = 11 THEN 'DATASET_EMPTY' WHEN doc_id % 37 = 5 THEN 'DATASET_STRUCTURE_CHANGED'
    WHEN n_rows = 1 THEN NULL
    WHEN doc_id % 41 = 6 THEN 'DATASET_STRUCTURE_CHANGED' WHEN doc_id % 47 = 8 THEN 'REGION_MAPPING_MISSING'
    WHEN doc_id % 43 = 7 THEN 'PRICE_VALUE_INVALID' WHEN doc_id % 59 = 10 THEN 'MARKET_IDENTITY_INVALID'
    WHEN doc_id % 53 = 9 THEN 'DATASET_DUPLICATE_ROW' WHEN doc_id % 67 = 12 THEN 'MARKET_IDENTITY_INVALID' END AS error_code
  FROM market_pages)"""


def market_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind.dealt_frame(spark, sf_dir, "market_pages", "orders", "o_orderkey", "o_custkey", "o_orderdate")


def market_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.market_rows(market_docs(spark, sf_dir))


@query(
    "market_page_faults",
    "SRC-07 RUL-13",
    ctes("market_pages", extra=_MARKET_ERROR) + "SELECT doc_id, error_code FROM judged WHERE error_code IS NOT NULL",
)
def market_page_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.market_documents(market_table(spark, sf_dir))


_MARKET_ROWS = _MARKET_ERROR + f""",
listed AS (SELECT doc_id, source_date, commodity_id, market_id, region AS region_name, '市场A' AS market_name, price1 AS p FROM judged
    WHERE error_code IS NULL
  UNION ALL SELECT doc_id, source_date, commodity_id, market_id, '海南省', '市场A', price2 FROM judged WHERE error_code IS NULL AND n_rows > 1
  UNION ALL SELECT doc_id, source_date, commodity_id, '77', '广东省', '市场C', '7.00' FROM judged WHERE error_code IS NULL AND n_rows > 2),
market AS (SELECT doc_id, source_date, commodity_id, market_id, market_name, {sql_map(vocab.REGION_CODES, 'region_name')} AS region_code,
    CAST(p AS DECIMAL(18,2)) AS price, p AS price_text, CAST(source_date AS TIMESTAMP) - INTERVAL 8 HOUR AS observed_at FROM listed)"""


@query(
    "market_page_rows",
    "SRC-07 FN-22 FN-36 FN-39",
    ctes("market_pages", extra=_MARKET_ROWS)
    + "SELECT doc_id, commodity_id, market_id, market_name, region_code, price, observed_at FROM market",
)
def market_page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.market_candidates(market_table(spark, sf_dir)).select(
        "doc_id", "commodity_id", "market_id", "market_name", "region_code", "price", "observed_at"
    )


# Parts as product pages with two priced links.
bind.VIEWS["product_pages"] = """
SELECT p_partkey AS doc_id, 'https://www.apple.com.cn/shop/buy-iphone/' || slug AS page_url, p_size, p_partkey, slug,
       '<h1>购买 X</h1><div class="item"><a href="/shop/buy-iphone/' || slug || '/FX' || CAST(p_partkey AS STRING) || 'CH/A">'
       || '<span class="dimensionCapacity">' || CAST(p_size AS STRING) || '<small>GB</small></span>'
       || '<span class="dimensionColor">深　蓝</span><span class="price">'
       || CASE WHEN p_size % 3 = 0 THEN '<del>RMB 9,999</del>' WHEN p_size % 3 = 1 THEN '<span class="original_price">RMB 8,888</span>' ELSE '' END
       || CASE WHEN p_partkey % 11 = 3 THEN '' ELSE '<span class="current_price">RMB ' || CAST(p_partkey + 1 AS STRING) || '</span>' END
       || '</span></a>' || CASE WHEN p_partkey % 4 = 0 THEN '<span>暂时缺货</span>' ELSE '' END
       || '</div><a href="/shop/buy-iphone/other">other</a>' AS html
FROM (SELECT *, replace(p_name, ' ', '-') AS slug FROM {part}) x
"""


@query(
    "priced_links",
    "SRC-10",
    ctes("product_pages")
    + """SELECT doc_id, 'FX' || CAST(p_partkey AS VARCHAR) || 'CH/A' AS part_number,
           CASE WHEN p_partkey % 11 != 3 THEN 'RMB ' || CAST(p_partkey + 1 AS VARCHAR) END AS current_text,
           CASE p_size % 3 WHEN 0 THEN 'RMB 9,999' WHEN 1 THEN 'RMB 8,888' END AS original_text,
           CASE p_size % 3 WHEN 0 THEN '划线原价' WHEN 1 THEN '原价' END AS original_label,
           '{"capacity":"' || CAST(p_size AS VARCHAR) || ' GB","color":"深 蓝"}' AS dimensions,
           CASE WHEN p_partkey % 4 = 0 THEN 'OUT_OF_STOCK' ELSE 'ON_SALE' END AS availability,
           CASE WHEN p_partkey % 11 = 3 THEN 'SKU_INCOMPLETE' END AS error FROM product_pages""",
)
def priced_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.priced_anchors(spread(bind.settled(bind.frame(spark, sf_dir, "product_pages"))))
    return rows.drop("url").withColumn("dimensions", canonical_json(c("dimensions")))


# Parts as JSON evidence of the other malls.
bind.VIEWS["snapshot_docs"] = """
SELECT p_partkey AS doc_id, p_size, CASE p_partkey % 2 WHEN 0 THEN 'HUAWEI' ELSE 'OPPO' END AS brand,
       CASE WHEN p_partkey % 13 = 5 THEN 'not json' ELSE
       '{"schema":"' || CASE WHEN p_partkey % 17 = 3 THEN 'old' ELSE 'evidence-1' END || '","source_url":"https://mall.example/'
       || CAST(p_partkey AS STRING) || '","snapshots":[{"selections":{"version":"8GB+' || CAST(p_size AS STRING) || 'GB","color":"'
       || CASE WHEN p_partkey % 19 = 1 THEN ' ' ELSE '灰' END || '"},"html":"<section data-sku-id=''S' || CAST(p_partkey AS STRING)
       || '''><h1>HUAWEI Mate ' || CAST(p_size AS STRING) || '</h1><del>¥ 5,999</del><div class=''current-price''>¥ '
       || CAST(p_size + 100 AS STRING) || '</div><button>立即购买</button></section>"},{"selections":{"color":"蓝"},"html":"<section data-sku-id=''T'
       || CAST(p_partkey AS STRING) || '''><h1 class=''product-name''>HUAWEI Mate ' || CAST(p_size AS STRING)
       || '</h1><button>已下架</button></section>"}]}' END AS body
FROM {part}
"""


@query(
    "snapshot_skus",
    "SRC-03 FN-17",
    ctes(
        "snapshot_docs",
        extra="""s AS (SELECT *, CASE WHEN doc_id % 13 = 5 THEN 'EVIDENCE_NOT_JSON' WHEN doc_id % 17 = 3 THEN 'SCHEMA_UNSUPPORTED' END AS de
          FROM snapshot_docs)""",
    )
    + """SELECT doc_id, 0 AS snapshot_no, coalesce(de, CASE WHEN doc_id % 19 = 1 THEN 'SNAPSHOT_INVALID' END) AS error,
           'S' || doc_id AS sku_id, 'HUAWEI Mate ' || p_size AS name, '¥ ' || (p_size + 100) AS current_text,
           '¥ 5,999' AS original_text, 'ON_SALE' AS availability FROM s WHERE doc_id % 13 != 5
         UNION ALL SELECT doc_id, 1, de, 'T' || doc_id, 'HUAWEI Mate ' || p_size, NULL, NULL, 'OFF_SHELF' FROM s WHERE doc_id % 13 != 5
         UNION ALL SELECT doc_id, NULL, de, NULL, NULL, NULL, NULL, 'UNKNOWN' FROM s WHERE doc_id % 13 = 5""",
)
def snapshot_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.dealt_frame(spark, sf_dir, "snapshot_docs", "part", "p_partkey", "p_size")
    rows = envelopes.snapshot_rows(docs, TAG)
    return envelopes.snapshot_skus(rows).select(
        "doc_id", "snapshot_no", "error", "sku_id", "name", "current_text", "original_text", "availability"
    )


bind.VIEWS["batch_docs"] = """
SELECT p_partkey AS doc_id, p_size, p_partkey,
       '{"schema":"evidence-1","responses":[' || r1 || CASE WHEN p_partkey % 7 = 2 THEN '' ELSE ',' || r2 END || ']}' AS body
FROM (SELECT *, head || '"1","color":"黑","skuAttributes":{"key1":"黑","key2":"' || v || '","key3":"套餐一"}' || tail AS r1,
             head || '"2","skuAttributes":{"key1":"白","key2":"' || v || '","key3":"套餐一"}' || tail AS r2
      FROM (SELECT *, '12GB+' || CAST(p_size AS STRING) || 'GB' AS v,
              '{"spuId":"' || CAST(p_partkey AS STRING) || '","seoTitle":"OPPO Reno ' || CAST(p_size AS STRING) || '","price":"'
              || CAST(p_size * 10 AS STRING) || '","bty_type":"立即购买","skuId":' AS head,
              ',"attributeList":[{"value":[{"key":"key1","_$text1":"颜色","items":[{"skuId":"1","attributes":{"key1":"黑","key3":"套餐一"}},'
              || '{"skuId":"2","attributes":{"key1":"白","key3":"套餐一"}},{"skuId":"3","attributes":{"key1":"白","key3":"套餐二"}}]},'
              || '{"key":"key2","_$text1":"版本"},{"key":"' || CASE WHEN p_partkey % 23 = 4 THEN 'key1' ELSE 'key3' END
              || '","_$text1":"套餐"}]}]}' AS tail FROM {part}) x) y
"""


@query(
    "detail_batches",
    "SRC-04 FN-25",
    ctes("batch_docs")
    + """, r AS (SELECT *, 1 AS n, '黑' AS colour FROM batch_docs UNION ALL SELECT *, 2, '白' FROM batch_docs WHERE p_partkey % 7 != 2)
         SELECT doc_id, CAST(p_partkey AS VARCHAR) AS product_id, CAST(n AS VARCHAR) AS sku_id,
           CASE WHEN p_partkey % 23 != 4 OR n = 1 THEN colour END AS color,
           CASE WHEN p_partkey % 23 != 4 THEN '{"套餐":"套餐一","版本":"12GB+' || p_size || 'GB","颜色":"' || colour || '"}' END AS dimensions,
           CASE WHEN p_partkey % 23 = 4 THEN 'LABEL_CONFLICT' END AS row_error FROM r""",
)
def detail_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.settled(bind.frame(spark, sf_dir, "batch_docs"))
    rows = envelopes.detail_batch_rows(docs, TAG)
    return rows.select(
        "doc_id", "product_id", "sku_id", "color",
        canonical_json(sorted_map(c("dimensions"))).alias("dimensions"), "row_error",
    )


@query(
    "batch_coverage",
    "SRC-04 SET-02",
    ctes("batch_docs")
    + """SELECT doc_id, CASE WHEN p_partkey % 7 = 2 THEN 1 ELSE 2 END AS skus, 0 AS repeated,
           CASE WHEN p_partkey % 7 = 2 THEN 1 ELSE 0 END + CASE WHEN p_partkey % 23 = 4 THEN 1 ELSE 0 END AS omitted,
           CASE WHEN p_partkey % 7 = 2 OR p_partkey % 23 = 4 THEN 'SKU_COVERAGE_INCOMPLETE' END AS error FROM batch_docs""",
)
def batch_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.settled(bind.frame(spark, sf_dir, "batch_docs"))
    return envelopes.detail_batch_coverage(envelopes.detail_batch_rows(docs, TAG)).select(
        "doc_id", c("skus").cast("int").alias("skus"), c("repeated").cast("int").alias("repeated"),
        c("omitted").cast("int").alias("omitted"), "error",
    )


bind.VIEWS["map_docs"] = """
SELECT p_partkey AS doc_id, p_partkey, p_size, p_type,
       '{"schema":"evidence-1","commoditySpu":{"id":"' || CAST(p_partkey AS STRING) || '","spuName":"vivo X' || CAST(p_size AS STRING)
       || '"},"specItem":{"specMainSeq":{"0":"版本","1":"颜色"},"specItemSeq":{"0":[{"name":"8GB+' || CAST(p_size AS STRING)
       || 'GB"},{"name":"b"}],"1":[{"name":"黑"},{"name":"白"}]},"skuSpecList":[{"skuId":"1","sequences":{"0":"1","1":"'
       || CASE WHEN p_partkey % 11 = 3 THEN '9' ELSE '1' END || '"}},{"skuId":"2","sequences":{"0":"2"'
       || CASE WHEN p_partkey % 13 = 4 THEN '' ELSE ',"1":"2"' END || '}}]},"downSkuIds":[' || CASE WHEN p_size % 4 = 0 THEN '"1"' ELSE '' END
       || '],"zeroStoreSkuIds":[' || CASE WHEN p_size % 5 = 0 THEN '"2"' ELSE '' END || '],"details":{"1":{"salePrice":"' || CAST(p_size * 7 AS STRING)
       || '","marketable":1,"skuStatus":{"hasStore":1}}' || CASE WHEN p_partkey % 17 = 6 THEN '' ELSE
          ',"2":{"salePrice":null,"marketPrice":"999","marketable":' || CAST(p_size % 2 AS STRING) || ',"skuStatus":{"hasStore":1}}' END || '}}' AS body
FROM {part}
"""


@query(
    "detail_maps",
    "SRC-05 FN-24 FN-18",
    ctes("map_docs")
    + """SELECT doc_id, '1' AS sku_id, CASE WHEN p_partkey % 11 != 3 THEN '{"版本":"8GB+' || p_size || 'GB","颜色":"黑"}' END AS dimensions,
           CAST(p_size * 7 AS VARCHAR) AS current_text, CASE WHEN p_size % 4 = 0 THEN 'OFF_SHELF' ELSE 'ON_SALE' END AS availability,
           CASE WHEN p_partkey % 11 = 3 THEN 'SPEC_UNRESOLVED' END AS error FROM map_docs
         UNION ALL SELECT doc_id, '2', CASE WHEN p_partkey % 13 != 4 THEN '{"版本":"b","颜色":"白"}' END, NULL,
           CASE WHEN p_partkey % 17 = 6 THEN NULL WHEN p_size % 2 = 0 THEN 'OFF_SHELF' WHEN p_size % 5 = 0 THEN 'OUT_OF_STOCK' ELSE 'ON_SALE' END,
           CASE WHEN p_partkey % 17 = 6 THEN 'SKU_COVERAGE_INCOMPLETE' WHEN p_partkey % 13 = 4 THEN 'SPEC_DIMENSIONS_MISSING' END FROM map_docs""",
)
def detail_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.settled(bind.frame(spark, sf_dir, "map_docs"))
    return envelopes.detail_map_rows(docs, TAG).select(
        "doc_id", "sku_id", canonical_json(sorted_map(c("dimensions"))).alias("dimensions"),
        "current_text", "availability", "error",
    )


bind.VIEWS["embedded_docs"] = """
SELECT p_partkey AS doc_id, p_partkey, p_size,
       CASE WHEN p_partkey % 9 = 4 THEN '<html>nothing</html>' ELSE
       '<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"mainData":{"current":{"prdId":"' || CAST(p_partkey AS STRING)
       || '","name":"HUAWEI　Mate ' || CAST(p_size AS STRING) || '","productOptions":{"sbomList":{"a":{"sbomCode":"S' || CAST(p_partkey AS STRING)
       || '","price":' || CAST(p_size AS STRING) || '.5,"inventory":' || CAST(p_size % 3 AS STRING) || ',"commingSoonFlag":' || CAST(p_partkey % 2 AS STRING)
       || ',"gbomAttrList":[{"attrName":"颜色","attrValue":"黑"},{"attrName":"' || CASE WHEN p_partkey % 5 = 1 THEN '颜色' ELSE '版本' END
       || '","attrValue":"8GB"}]}}}}}}}}</script><script>var x = 1; productSelectionData: {"products":[' || CAST(p_partkey AS STRING)
       || ']}, more: 2</script></html>' END AS html
FROM {part}
"""


@query(
    "embedded_json",
    "SRC-06 FN-26",
    ctes("embedded_docs")
    + """SELECT doc_id, CASE WHEN p_partkey % 9 != 4 THEN 'S' || p_partkey END AS sku_id,
           CASE WHEN p_partkey % 9 != 4 THEN 'HUAWEI Mate ' || p_size END AS name,
           CASE WHEN p_partkey % 9 != 4 AND p_partkey % 5 != 1 THEN '{"版本":"8GB","颜色":"黑"}' END AS attributes,
           CASE WHEN p_partkey % 9 != 4 THEN p_size || '.5' END AS current_text,
           CASE WHEN p_partkey % 9 = 4 THEN 'UNKNOWN' WHEN p_partkey % 2 = 1 THEN 'COMING_SOON' WHEN p_size % 3 > 0 THEN 'ON_SALE' ELSE 'UNKNOWN' END AS availability,
           CASE WHEN p_partkey % 9 = 4 THEN 'EMBEDDED_DATA_MISSING' WHEN p_partkey % 5 = 1 THEN 'ATTRIBUTES_AMBIGUOUS' END AS error,
           CASE WHEN p_partkey % 9 != 4 THEN '{"products": [' || p_partkey || ']}' END AS selection FROM embedded_docs""",
)
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.settled(bind.frame(spark, sf_dir, "embedded_docs"))
    marked = docs.select(
        "doc_id", envelopes.json_after_marker(c("html"), "productSelectionData").alias("selection")
    )
    rows = envelopes.embedded_rows(docs).select(
        "doc_id", "sku_id", "name", canonical_json(sorted_map(c("attributes"))).alias("attributes"),
        "current_text", "availability", "error",
    )
    return rows.join(marked, "doc_id")


bind.VIEWS["discovery_docs"] = (
    "SELECT p_partkey AS doc_id, p_partkey, p_size, brand, name, CASE WHEN p_partkey % 17 = 3 THEN '{\"code\":0,\"data\":[' "
    "WHEN p_partkey % 17 = 5 THEN '{\"code\":1,\"data\":[]}' ELSE '{\"code\":0,\"data\":[{\"list\":[{\"prdId\":\"' || CAST(p_partkey AS STRING) || '\",\"prdName\":\"' || name || "
    "'\"},{\"deep\":{\"prdId\":\"' || CAST(p_partkey AS STRING) || '\",\"prdName\":\"later\",\"x\":[{\"prdId\":\"x9\",\"prdName\":\"' || name || '\"}]}}]},{\"prdId\":' || CAST(p_size + 1000000 AS STRING) || "
    "',\"briefName\":\"' || name || '\"}]}' END AS body FROM {device_names}"
)


@query(
    "json_discovery",
    "SRC-09",
    ctes(
        "discovery_docs",
        extra=f"""n AS (SELECT *, {sql_squeeze('name')} AS t, upper({sql_squeeze('name')}) AS u FROM discovery_docs),
          k AS (SELECT *, CASE brand {' '.join(f"WHEN '{b}' THEN {_sql_category(b)}" for b in BRANDS4)} END AS category_code FROM n)""",
    )
    + """, r AS (SELECT *, p_partkey % 17 NOT IN (3, 5) AS whole FROM k)
         SELECT doc_id, CAST(p_partkey AS VARCHAR) AS product_id, 0 AS position, t AS name, category_code, NULL AS error
         FROM r WHERE category_code IS NOT NULL AND whole
         UNION ALL SELECT doc_id, CAST(p_size + 1000000 AS VARCHAR), 3, t, category_code, NULL FROM r
         WHERE category_code IS NOT NULL AND whole
         UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, CASE p_partkey % 17 WHEN 3 THEN 'JSON_UNREADABLE'
           WHEN 5 THEN 'DISCOVERY_EMPTY' ELSE 'NO_APPROVED_PRODUCT' END FROM r WHERE category_code IS NULL OR NOT whole""",
)
def json_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bind.dealt_frame(spark, sf_dir, "discovery_docs", "part", "p_partkey", "p_size", "p_name")
    objects = envelopes.walk_objects(docs.where(c("doc_id").isNotNull()), "doc_id", "body", "prdId", ("brand",))
    return envelopes.discovered_products(objects, c("brand"), "prdId", ["prdName", "briefName"])


_LABEL_ROWS = " UNION ALL ".join(
    f"SELECT l_orderkey AS doc_id, {i} AS row_no, 2 + l_partkey AS col_no, {expr} AS value, "
    "CASE WHEN l_suppkey % 8 = 0 THEN '0.0' ELSE '0.00_ ' END AS number_format FROM {sheet_lines}"
    for i, expr in enumerate(
        ["commodity_group", "commodity_name", "' ' || specification", "'元/500克'", "price_cell"], 1
    )
) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT DISTINCT l_orderkey, {i}, 0, "
    + (f"CASE WHEN l_orderkey % 29 = 3 THEN '其他' ELSE '{label}' END" if label == "规格" else f"' {label}'")
    + ", CAST(NULL AS STRING) FROM {sheet_lines}"
    for i, label in enumerate(vocab.SHEET_LABELS, 1)
)
bind.VIEWS["sheet_lines"] = (
    "SELECT l_orderkey, l_partkey, l_suppkey, "
    + pick("l_partkey", [r[1] for r in vocab.CITY_COMMODITIES]) + " AS commodity_group, "
    + pick("l_partkey", [r[2] for r in vocab.CITY_COMMODITIES]) + " AS commodity_name, "
    + pick("(l_partkey + CASE WHEN l_suppkey % 9 = 0 THEN 1 ELSE 0 END)", [r[3] for r in vocab.CITY_COMMODITIES])
    + " AS specification, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) || '5' AS price_cell FROM {lineitem}"
)
bind.VIEWS["sheet_cells"] = _LABEL_ROWS


@query(
    "sheet_prices",
    "SRC-11 JON-11 FN-38",
    ctes("sheet_lines")
    + ", w AS (SELECT * FROM (VALUES "
    + ", ".join(str(r[:4]) for r in vocab.CITY_COMMODITIES)
    + """) AS t(commodity_code, commodity_group, commodity_name, specification)),
      cols AS (SELECT l_orderkey AS doc_id, l_partkey, max(commodity_group) AS commodity_group, max(commodity_name) AS commodity_name,
          max(specification) AS specification, max(price_cell) AS cell,
          max(CASE WHEN l_suppkey % 8 = 0 THEN '0.0' ELSE '0.00_ ' END) AS fmt FROM sheet_lines GROUP BY 1, 2),
      hits AS (SELECT doc_id, commodity_code, count(*) AS matches, min(CASE WHEN fmt = '0.00_ '
          THEN CAST(CAST(cell AS DECIMAL(18,3)) AS DECIMAL(18,2)) END) AS price FROM cols
        JOIN w USING (commodity_group, commodity_name, specification) WHERE doc_id % 29 != 3 GROUP BY 1, 2),
      own AS (SELECT d.doc_id, w.commodity_code, row_number() OVER (PARTITION BY d.doc_id ORDER BY w.no) AS no,
          coalesce(matches, 0) AS matches, price,
          CASE WHEN coalesce(matches, 0) != 1 THEN 'COMMODITY_MAPPING_MISSING' WHEN price IS NULL THEN 'PRICE_VALUE_INVALID' END AS row_error
        FROM (SELECT DISTINCT l_orderkey AS doc_id FROM sheet_lines) d
        CROSS JOIN (SELECT *, row_number() OVER () AS no FROM w) w LEFT JOIN hits USING (doc_id, commodity_code))
      SELECT doc_id, commodity_code, matches, price, row_error, CASE WHEN doc_id % 29 = 3 THEN 'DATASET_STRUCTURE_CHANGED'
        ELSE first_value(row_error IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY no
          ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS error_code FROM own""",
)
def sheet_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sheets.sheet_prices(bind.frame(spark, sf_dir, "sheet_cells"))


@query(
    "evidence_manifest",
    "SRC-14",
    """SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN 2 ELSE 1 END + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS parts,
         '[{"role":"discovery_context","source_hash":null}' ||
         CASE WHEN o_custkey % 4 = 0 OR o_orderstatus = 'F' THEN ',' ELSE '' END ||
         CASE WHEN o_custkey % 4 = 0 THEN '{"role":"source_page","source_hash":"' || sha256('p' || o_orderkey) || '"}' ELSE '' END ||
         CASE WHEN o_custkey % 4 = 0 AND o_orderstatus = 'F' THEN ',' ELSE '' END ||
         CASE WHEN o_orderstatus = 'F' THEN '{"role":"response","source_hash":"' || sha256('r' || o_orderkey) || '"}' ELSE '' END || ']' AS raw
       FROM orders""",
)
def evidence_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(role: str, digest: F.Column) -> F.Column:
        return F.struct(F.lit(role).alias("role"), digest.alias("source_hash"))

    number = c("o_orderkey").cast("string")
    page = part("source_page", F.sha2(F.concat(F.lit("p"), number), 256))
    response = F.when(
        c("o_orderstatus") == "F", part("response", F.sha2(F.concat(F.lit("r"), number), 256))
    )
    listed = F.when(c("o_custkey") % 4 == 0, F.array(page)).otherwise(
        F.array().cast("array<struct<role:string,source_hash:string>>")
    )
    whole = evidence.manifest(part("discovery_context", F.lit(None).cast("string")), listed, response)
    return bind.frame(spark, sf_dir, "orders").select(
        "o_orderkey", F.size(whole).alias("parts"), canonical_json(whole).alias("raw")
    )
