"""A corpus pipeline of five stages over ``documents``; each works on all that its predecessor kept.

1. quality rules: documents that the rules reject go.
2. n-gram Jaccard join: one document of each class of copies and near copies stays.
3. suffix-array dedup: bytes of repeated long strings go; a text of which nothing stays goes with them.
4. benchmark decontamination: hit stretches go, and documents that are mostly hits.
5. BPE encoding and decoding: ids and decoded text of what is left.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of ``documents``, with n_chars set to the new length where a text changed. ``docs`` must be a stored table.

Defined results: a null, empty or blank text is rejected by the first stage; rows that are equal are
copies, of which the second keeps one; a null doc_id stays; a table without rows gives one at every stage.
Extra columns are passed on as far as the last stage, which returns doc_id, counts, digests, ids and the decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata.llm import bpe, nearcopies, quality, repeats, spans, texts
from pricestrata.session import table


#: Bytes of a passage that the third stage removes: fewer than 50 words of prose take (97 of 100 shared
#: runs of 50 words are longer), where operator 5 by itself looks for 400.
PASSAGE = 240


def _measured(new: DataFrame) -> DataFrame:
    """n_chars follows the text where the table has that column."""
    if "n_chars" not in new.columns:
        return new
    return new.withColumn("n_chars", F.char_length("text").cast(new.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps a document if the base rules and the model do; the model learns from ``labels``."""
    texts.bounded_batches(spark)
    rules = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, rules)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class."""
    texts.bounded_batches(spark)
    return nearcopies.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated bytes; drops documents without a word left."""
    texts.bounded_batches(spark)
    return _measured(repeats.strip(docs, PASSAGE)).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of ``benchmark``."""
    texts.bounded_batches(spark)
    return _measured(spans.clean(docs, table(spark, sf_dir, "benchmark")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, with their counts and digests."""
    texts.bounded_batches(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("bpe", encoded),
]

#: The classifier of the first stage is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = texts.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
