"""Token counts kept as additive totals by source, language and tokenizer version.

A batch of signed changes is summed per key and written to a folder of its own, named by the
batch id. The folder counts once its success mark is there; a batch id that has one is skipped,
and a folder without one (a lost driver) is written anew. So a batch can be sent any number of times.
Totals are the sum over committed folders; nothing is ever updated in place.

Changes have the columns source, lang, tokenizer_version, n_docs, n_tokens:
- an insert counts +1 document and +its tokens, a delete -1 and -its tokens;
- a revised count is a delete under the old version and an insert under the new one.

Defined results
- null source or lang is a key of its own; null text has 0 tokens and still counts as a document.
- repeated rows count as often as they occur; an empty batch commits nothing but its mark.
- a key whose documents and tokens both cancel to 0 has no row in the totals.
- extra columns of the documents are ignored.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata.llm import texts

KEYS = ("source", "lang", "tokenizer_version")

#: The tokenizer versions that the query counts with: patterns of one token (fixed values).
VERSIONS = {
    "words/1": r"[^\x20\x09-\x0D]+",
    "words/2": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]",
}


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, lang, a digest of the text, and its tokens under each version, stored.

    Every text is read and counted once, whatever the number of batches made from it.
    """
    text = F.col("text").cast("string")
    counts = [F.coalesce(F.regexp_count(text, F.lit(p)), F.lit(0)).cast("bigint") for p in VERSIONS.values()]
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "lang",
        F.sha2(text.cast("binary"), 256).alias("digest"), F.array(*counts).alias("tokens"),
    )
    return texts.stored(rows, "token-counts")


def _tokens(version: str):
    return F.col("tokens")[list(VERSIONS).index(version)]


def counted(rows: DataFrame, version: str) -> DataFrame:
    """One insert per measured document under a version."""
    return rows.select(
        "source", "lang", F.lit(version).alias("tokenizer_version"),
        F.lit(1).cast("bigint").alias("n_docs"), _tokens(version).alias("n_tokens"),
    )


def deleted(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"n_docs": -F.col("n_docs"), "n_tokens": -F.col("n_tokens")})


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    return deleted(old).unionByName(new)


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def commit(root: str, batch_id: str, changes: DataFrame) -> bool:
    """Add one batch; False if a batch of that id is already in."""
    path = f"{root}/batch={quote(batch_id, safe='')}"
    spark = changes.sparkSession
    if _exists(spark, f"{path}/_SUCCESS"):
        return False
    sums = changes.groupBy(*KEYS).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    sums.write.mode("overwrite").parquet(path)
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Sums over all committed batches."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batch=*/_SUCCESS"))
    paths = [x.getPath().getParent().toString() for x in found or []]
    schema = "source string, lang string, tokenizer_version string, n_docs bigint, n_tokens bigint"
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return (
        rows.groupBy(*KEYS)
        .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        .where("n_docs <> 0 or n_tokens <> 0")
    )


def first_copies(rows: DataFrame, version: str) -> DataFrame:
    """Inserts of one measured row per distinct text: the least (doc_id, source, lang).

    Copies are combined before the shuffle: a text that a third of the rows share costs one
    row a task.
    """
    kept = rows.groupBy("digest").agg(
        F.min(F.struct("doc_id", "source", "lang", _tokens(version).alias("n_tokens"))).alias("_first")
    )
    return kept.select(
        "_first.source", "_first.lang", F.lit(version).alias("tokenizer_version"),
        F.lit(1).cast("bigint").alias("n_docs"), "_first.n_tokens",
    )
