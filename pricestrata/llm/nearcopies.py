"""N-gram Jaccard join with Bayesian candidate pruning.

Two documents are linked if the Jaccard similarity of their sets of word shingles (five
words, a text of fewer words is one shingle) is at least the threshold.

1. Documents with one shingle set are copies; one of them stands for all.
2. MinHash bands find candidates: representatives that agree in a band fall into one candidate
   group (connected components over shared bands). With 32 bands of 4 values, a pair at
   similarity 0.8 shares none with a chance below 1e-7.
3. A group is compared in tiles of two blocks; large groups have many tiles, each a task's
   worth of work. In a tile the MinHash values of all pairs are compared in steps of 16; after each
   step pairs are dropped whose posterior chance of reaching the threshold is below ``TOLERANCE``.
4. The rest is verified exactly on the shingle sets, by counting common shingles.

A tile returns one row per linked document: its links in the tile and its local group, so
pairs are never written out. Classes are the components over those.

Defined results
- null, empty or blank text: no shingles, a class of its own, no links.
- copies (repeated rows too) share one class; n_links counts other shingle sets, n_copies the
  documents with the same set, itself included.
- class_id is the least doc_id of the class; null doc_ids are kept and never name a class,
  unless it holds no other. Extra columns are ignored.
- no rows: an empty result. ``docs`` must be a stored table (see texts.with_row_id).
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts
from pricestrata.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-9
#: Documents of a block; a tile holds two.
BLOCK = 256
_U = np.uint64


def _odd(n: int, seed: int) -> np.ndarray:
    made = np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed)
    return texts.mix(made) | _U(1)


_A, _B = _odd(HASHES, 17), _odd(HASHES, 71)


def shingles(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, bounds per text), repeats included."""
    data, offsets = texts.utf8(column)
    starts, ends, before = texts.spans(~texts.SPACE[data], offsets)
    word = texts.mix(texts.ranged(texts.prefix(data), starts, ends))
    count = np.diff(before)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    first = np.repeat(before[:-1] - bounds[:-1], made) + np.arange(bounds[-1])
    width = np.minimum(np.repeat(count, made), size)
    code = np.zeros(len(first), np.uint64)
    for i in range(size):
        here = i < width
        code[here] = code[here] * _U(0x9E3779B97F4A7C15) + word[first[here] + i]
    return texts.mix(code), bounds


def signatures(code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash values of each text that has shingles, in the order of these texts."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(some), HASHES), np.uint32)
    if len(some):
        for i in range(HASHES):
            value = code * _A[i] + _B[i]
            out[:, i] = np.minimum.reduceat(value, bounds[some]) >> _U(32)
    return out


def least_matches(threshold: float, tolerance: float, hashes: int = HASHES, step: int = STEP) -> list[int]:
    """For each step: the fewest matches with which a pair is still worth comparing.

    With a uniform prior, m matches of n values give similarity the posterior Beta(m + 1,
    n - m + 1); the chance to reach the threshold is its upper tail, summed numerically.
    """
    x = (np.arange(200_000) + 0.5) / 200_000
    out = []
    for n in range(step, hashes + 1, step):
        for m in range(n + 1):
            log = m * np.log(x) + (n - m) * np.log1p(-x)
            weight = np.exp(log - log.max())
            if weight[x >= threshold].sum() / weight.sum() >= tolerance:
                out.append(m)
                break
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """Row id, doc_id, set digest (two numbers, null without shingles) and signature, stored."""

    def run(batches):
        for batch in texts.slices(batches):
            code, bounds = shingles(batch.column("text"))
            sig = iter(signatures(code, bounds))
            d1, d2, made = [], [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b:
                    d1.append(None), d2.append(None), made.append(None)
                    continue
                digest = hashlib.blake2b(np.unique(code[a:b]).tobytes(), digest_size=16).digest()
                d1.append(int.from_bytes(digest[:8], "little", signed=True))
                d2.append(int.from_bytes(digest[8:], "little", signed=True))
                made.append(next(sig).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rid"), batch.column("doc_id"), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64()), pa.array(made, pa.binary())],
                names=["rid", "doc_id", "d1", "d2", "sig"],
            )

    rows = texts.with_row_id(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    made = rows.select("_rid", "doc_id", "text").mapInArrow(
        run, "rid bigint, doc_id bigint, d1 bigint, d2 bigint, sig binary"
    )
    return texts.stored(made, "sketches")


def candidates(sets: DataFrame) -> DataFrame:
    """(rep, component) of the representatives that share a band with another one."""
    width = 4 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))),
    )
    keyed = sets.select("rep", F.explode(bands).alias("key"))
    shared = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1")
    # Dealt out anew, so that AQE can split a band that many representatives share.
    shared = shared.hint("rebalance")
    edges = keyed.join(shared.select("key", "first"), "key").where("rep <> first")
    return components(edges.select(F.col("rep").alias("a"), F.col("first").alias("b")))


def compare(sig: np.ndarray, left: np.ndarray, right: np.ndarray, least: list[int]):
    """Pairs that survive the incremental comparison of their MinHash values."""
    same = np.zeros(len(left), np.int32)
    for k, need in enumerate(least):
        part = slice(k * STEP, (k + 1) * STEP)
        same += (sig[left, part] == sig[right, part]).sum(axis=1, dtype=np.int32)
        keep = same >= need
        left, right, same = left[keep], right[keep], same[keep]
    return left, right


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common shingles of all pairs of sets."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    value, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(value), -1)
    place[shared] = np.arange(len(shared))
    column, out = place[column], np.zeros((n, n), np.float32)
    keep = column >= 0
    column, owner = column[keep], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 2048
    for at in range(0, len(shared), width):
        a, b = np.searchsorted(column, [at, at + width])
        dense = np.zeros((n, min(width, len(shared) - at)), np.float32)
        dense[owner[a:b], column[a:b] - at] = 1
        out += dense @ dense.T
    return out.astype(np.int64)  # sums below 2**24 are exact in this type


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> list[int]:
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def _tile(rows: list[dict], threshold: Fraction, least: list[int]):
    """(rep, local root, links) of the linked documents of one tile."""
    rows.sort(key=lambda r: r["rep"])
    block = np.array([r["block"] for r in rows])
    left, right = np.triu_indices(len(rows), 1)
    if rows[0]["lo"] != rows[0]["hi"]:
        across = block[left] != block[right]  # pairs inside a block belong to its own tile
        left, right = left[across], right[across]
    sig = np.array([np.frombuffer(r["sig"], np.uint32) for r in rows])
    left, right = compare(sig, left, right, least)
    if not len(left):
        return
    own = np.unique(np.concatenate([left, right]))
    code, bounds = shingles(pa.array([rows[i]["text"] for i in own], pa.string()))
    sets = [np.unique(code[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    size = np.array([len(s) for s in sets], np.int64)
    left, right = np.searchsorted(own, left), np.searchsorted(own, right)
    both = common(sets)[left, right]
    union = size[left] + size[right] - both
    linked = both * threshold.denominator >= union * threshold.numerator
    left, right = left[linked], right[linked]
    links = np.bincount(left, minlength=len(own)) + np.bincount(right, minlength=len(own))
    for i, r in enumerate(_roots(len(own), left, right)):
        if links[i]:
            yield rows[own[i]]["rep"], rows[own[r]]["rep"], int(links[i])


def verified(docs: DataFrame, groups: DataFrame, sets: DataFrame, threshold: float, tolerance: float):
    """(rep, root, links) per tile: the exact links inside the candidate groups."""
    sizes = groups.groupBy("component").agg(F.count("*").alias("n"))
    placed = groups.join(sizes, "component").select(
        F.col("node").alias("rep"), "component", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    texted = texts.with_row_id(docs.select("text"), "rep").select("rep", "text")
    rows = placed.join(sets.select("rep", "sig"), "rep").join(texted, "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        "component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "rep", "sig", "text",
    )
    part = ("component", "lo", "hi")
    rows = rows.repartition(*part).sortWithinPartitions(*part)
    limit, least = Fraction(str(threshold)), least_matches(threshold, tolerance)

    def run(batches):
        held: list[dict] = []
        out: list[tuple] = []

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(3)],
                names=["rep", "root", "links"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if held and any(held[0][k] != row[k] for k in part):
                    out += _tile(held, limit, least)
                    held = []
                held.append(row)
                if len(out) > 20_000:
                    yield batch_of(out)
                    out = []
        if held:
            out += _tile(held, limit, least)
        yield batch_of(out)

    return texts.stored(rows.mapInArrow(run, "rep bigint, root bigint, links bigint"), "links")


def classed(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """rid, doc_id, first (row id of the class's first row), class_id, n_links, n_copies."""
    sketches = sketched(docs)
    sets = (
        sketches.where("d1 is not null")
        .groupBy("d1", "d2")
        .agg(
            F.min(F.struct("rid", "sig")).alias("_first"), F.count("*").alias("n_copies"),
            F.min("doc_id").alias("least_id"),
        )
        .select("d1", "d2", F.col("_first.rid").alias("rep"), F.col("_first.sig").alias("sig"),
                "n_copies", "least_id")
    )
    sets = texts.stored(sets, "sets")
    links = verified(docs, candidates(sets), sets, threshold, tolerance)
    groups = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("links").alias("n_links"))
    reps = (
        sets.drop("sig")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .join(counts, "rep", "left")
        .withColumn("first", F.coalesce("component", "rep"))
    )
    named = reps.groupBy("first").agg(F.min("least_id").alias("class_id"))
    reps = reps.join(named, "first").select(
        "d1", "d2", "first", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies"
    )
    found = sketches.drop("sig").join(reps, ["d1", "d2"], "left")
    return found.select(
        "rid", "doc_id", F.coalesce("first", "rid").alias("first"),
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
    )


def near_copies(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every document."""
    return classed(docs, **options).select("doc_id", "class_id", "n_links", "n_copies")


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """The documents without the later members of each class, all columns kept."""
    rid = texts.free_name(docs, "_rid")
    later = classed(docs, **options).where("rid <> first").select(F.col("rid").alias(rid))
    rows = texts.with_row_id(docs, rid).join(later, rid, "left_anti")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns))
