"""Registered queries of the operators, and their comparison SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricestrata.llm import (
    alignment,
    bpe,
    language,
    licences,
    mixing,
    nearcopies,
    quality,
    repeats,
    rollup,
    sharding,
    spans,
    sqltext,
    texts,
    tokenfiles,
    trie,
)
from pricestrata.session import table

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
            texts.bounded_batches(spark)
            return run(spark, sf_dir)

        REGISTRY[name] = Query(bounded, sql)
        return run

    return add


@query("op1_license_scan", sqltext.licences())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op9_feistel_shards", sqltext.shards())
def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op10_token_counts", sqltext.token_counts())
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents come in, are revised to a new version, then lose their exact copies."""
    docs = rollup.measured(table(spark, sf_dir, "documents"))
    root = texts.shared_path(spark, "token-counts")
    old, new = (rollup.counted(docs, version) for version in rollup.VERSIONS)
    rollup.commit(root, "load", old)
    rollup.commit(root, "revise", rollup.revised(old, new))
    rollup.commit(root, "load", old)  # a batch that comes again changes nothing
    kept = rollup.first_copies(docs, "words/2")
    rollup.commit(root, "drop-copies", rollup.revised(new, kept))
    return rollup.totals(spark, root)


@query("op3_bpe_codec")
def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


@query("op6_decontamination", sqltext.decontamination())
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    root = texts.shared_path(spark, "token-files")
    manifest = tokenfiles.write(table(spark, sf_dir, "documents"), root, path)
    return tokenfiles.read(spark, root, manifest, path)


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.near_copies(table(spark, sf_dir, "documents"))


@query("op5_suffix_dedup")
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents"))


@query("op11_conversation_trie", sqltext.conversation_trie())
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie.rebuilt_trie(table(spark, sf_dir, "conversations"))
    return nodes.select(*trie.NAMES[:-2])


@query("op12_mixing")
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
