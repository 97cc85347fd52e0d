"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered in order of (doc_id, size, text_crc32). The number is permuted by a keyed
Feistel network on pairs below ``side``, with side * side >= rows; a value that lands at or
beyond the row count is permuted again until it does not (cycle walking), so the result is a
permutation of the row numbers. shard = value mod shards and slot = value div shards: sizes of
shards differ by one row at most, slots have no gaps, and both are computable from the row
number, the seed and the row count alone.

Only doc_id, size and checksum are shuffled, never the text. Built-in functions only.

Defined results
- null text: size 1, checksum 0. null doc_id: kept, such rows are numbered first.
- repeated rows get numbers of their own; which of two equal rows gets which does not show.
- no rows: an empty result. Extra columns are ignored.
- equal rows are told apart by their place in the scan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.llm import texts

SHARDS = 8
SEED = 20_240_229
ROUNDS = 6
#: Steps of cycle walking. A step leaves the range with a chance of about 2 / side; should the
#: steps ever not do, the query fails instead of returning a wrong slot.
WALKS = 64
_MOD = 2_147_483_647  # prime, so that products of two residues fit a signed 64-bit number


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Multiplier and addend per round, from a linear congruential walk over the seed."""
    keys, x = [], seed % _MOD
    for _ in range(rounds):
        x = (x * 48_271 + 11) % _MOD
        a = x | 1
        x = (x * 48_271 + 11) % _MOD
        keys.append((a, x))
    return keys


def permuted(number: Column, rows: int, seed: int = SEED) -> Column:
    """The place of a row number below ``rows`` in the shuffled order."""
    side = max(2, math.isqrt(max(rows - 1, 0)) + 1)
    size, m = F.lit(side).cast("bigint"), F.lit(_MOD).cast("bigint")
    keys = F.array(
        *(
            F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
            for a, b in round_keys(seed)
        )
    )

    def scrambled(r: Column, key: Column) -> Column:
        # Two quadratic residues make one round; the value is used once per nesting level.
        first = F.transform(F.array((r * key["a"] + key["b"]) % m), lambda t: (t * t) % m)
        return F.element_at(first, 1) % size

    def network(x: Column) -> Column:
        start = F.struct(
            F.floor(x / size).cast("bigint").alias("l"), (x % size).cast("bigint").alias("r")
        )
        done = F.aggregate(
            keys,
            start,
            lambda s, k: F.struct(
                s["r"].alias("l"), ((s["l"] + scrambled(s["r"], k)) % size).alias("r")
            ),
            lambda s: s["l"] * size + s["r"],
        )
        return done

    limit = F.lit(rows).cast("bigint")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        network(number),
        lambda x, _: F.when(x < limit, x).otherwise(network(x)),
    )
    return walked


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, number) of all rows, stored, and how many there are."""
    text = F.col("text").cast("string")
    small = docs.select("doc_id", "text").withColumn("_rid", F.monotonically_increasing_id()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
        "_rid",
    )
    keys = ("doc_id", "size", "text_crc32", "_rid")
    # The last key splits a doc_id that a third of all rows share.
    placed = small.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # In a sorted partition this id is: partition number, then place.
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).drop("_rid")
    placed = texts.stored(placed, "numbered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = placed.select(
        "doc_id", "size", "text_crc32", part.alias("_part"), place.alias("_place")
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the range exchange: small enough for one task and a broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rows = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    out = placed.join(F.broadcast(bases.select("_part", "_base")), "_part").select(
        "doc_id", "size", "text_crc32", (F.col("_base") + F.col("_place")).alias("number")
    )
    return out, int(rows)


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Law ``rows``: every document with its shard and slot."""
    rows, n = numbered(docs)
    place = permuted(F.col("number"), n, seed)
    out = rows.withColumn("_p", place).withColumn(
        "_p",
        F.when(F.col("_p") < n, F.col("_p")).otherwise(
            F.raise_error(F.lit("cycle walking did not end")).cast("bigint")
        ),
    )
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_p") % shards).cast("int").alias("shard"),
        F.floor(F.col("_p") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
