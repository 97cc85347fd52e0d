"""Suffix-array dedup: remove every byte that lies in a long string which starts twice or more.

A window is a string of ``length`` bytes. Every window has one anchor, the position of the least
hash among the short grams that fit into it, so equal windows have equal anchors at equal places.
Neighbouring windows share anchors: an anchor owns a run of window starts, and the bytes from its first
start to the end of its last window are its block. There are about 2 anchors per ``length`` bytes.

1. Anchors whose gram occurs once own no repeated window and drop out. Blocks that occur twice
   or more are repeated as a whole.
2. For the other anchors, one per distinct block, two suffixes are sorted over all documents: the text
   from the anchor to the right and, reversed, to the left. A task sorts its suffixes into
   runs, keeps equal ones once, front-codes them (length of the prefix shared with the one before, and the rest) and
   sends each part of a run to the range of suffixes it belongs to. A range is merged with a
   loser tree that carries common prefix lengths: two heads are compared only beyond what
   both are known to share with the last winner. The merge yields, for each suffix, the longest prefix
   it shares with another one, hence how far an equal string can reach right and left of
   the anchor.
3. Only starts within both reaches can be repeated. The string over all of them is looked up
   first (usually it is repeated as a whole), and its single windows where it is not.

Looking up means counting 64-bit or 128-bit fingerprints: combined before the shuffle, joined
back with one row per fingerprint, which AQE can split. Ranges are cut by sampled suffixes of bounded
number; where a range border splits suffixes with a common gram, each run sends its neighbour of
the border to both sides, so no neighbour is missed.

Defined results
- null or empty text, or one shorter than ``length``: nothing is removed.
- a repeated row counts as another document, so both lose their bytes; strings are judged on the
  input, so no copy stays. Null doc_ids are kept. Extra columns are ignored.
- removed bytes may cut a character: digests are over bytes; ``strip`` drops broken characters.
- no rows: an empty result. ``docs`` must be a stored table (see texts.with_row_id).
"""

from __future__ import annotations

import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts

LENGTH = 400
GRAM = 32
#: Suffixes in one sorted run.
RUN = 20_000
#: Suffixes that a range should hold, and how many sampled suffixes cut a range border.
RANGE = 60_000
SAMPLES = 24
#: Sampled suffixes that the driver takes at most, whole (below two ``length`` each).
MAX_SAMPLES = 20_000
_LOW = np.uint64(0xFFFFFFFF)
_U = np.uint64

_TABLE = texts.mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1B54A32D192ED03))


def second(data: np.ndarray) -> np.ndarray:
    """Prefix sums like texts.prefix, over random values of the bytes: an independent hash."""
    up, _ = texts._POWERS.get(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=out[1:])
    return out


def gram_size(length: int) -> int:
    return max(1, min(GRAM, length // 4))


def sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least value of each window of ``width`` values, from minima inside blocks of that width."""
    n = len(key)
    if n < width:
        return key[:0]
    whole = -(-n // width) * width
    padded = np.full(whole, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = key
    table = padded.reshape(-1, width)
    head = np.minimum.accumulate(table, axis=1).ravel()
    tail = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[: n - width + 1], head[width - 1 : n])


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, anchor, first start, last start, gram hash, block hash) of each anchor."""
    gram = gram_size(length)
    width = length - gram + 1
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    fit = np.maximum(size - length + 1, 0)
    if not fit.sum():
        return none, none, none, none, none, none
    at = np.arange(len(data) - gram + 1)
    hashed = texts.mix(texts.ranged(texts.prefix(data), at, at + gram))
    least = sliding_least((hashed & ~_LOW) | at.astype(np.uint64), width)
    bounds = np.concatenate([[0], np.cumsum(fit)])
    owner = np.repeat(np.arange(len(size)), fit)
    start = np.arange(bounds[-1]) - bounds[owner] + offsets[owner]
    anchor = (least[start] & _LOW).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    owner, base = owner[first], offsets[owner[first]]
    lo, hi, anchor = start[first], start[last], anchor[first]
    block = texts.mix(texts.ranged(second(data), lo, hi + length) + (hi - lo).astype(np.uint64))
    return (
        owner, anchor - base, lo - base, hi - base,
        hashed[anchor].view(np.int64), block.view(np.int64),
    )


def anchors(rows: DataFrame, length: int) -> DataFrame:
    names = ["rid", "at", "lo", "hi", "gram", "block"]

    def run(batches):
        for batch in texts.slices(batches):
            data, offsets = texts.utf8(batch.column("text"))
            owner, *columns = anchors_of(data, offsets, length)
            rid = batch.column("_rid").to_numpy()[owner]
            kinds = [pa.int64()] + [pa.int32()] * 3 + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip([rid, *columns], kinds, strict=True)], names=names
            )

    schema = "rid bigint, at int, lo int, hi int, gram bigint, block bigint"
    return rows.select("_rid", "text").mapInArrow(run, schema)


# --- suffix runs and their merge ---------------------------------------------------------------


def shared_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """How many first bytes two strings share, known to be ``at`` or more."""
    end = min(len(a), len(b))
    while at < end:
        x, y = a[at : at + 64], b[at : at + 64]
        if x != y:
            n = min(len(x), len(y))
            differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
            return at + n - (differ.bit_length() + 7) // 8
        at += 64
    return end


def front_coded(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """(shared prefix lengths, rest lengths, rests) of sorted strings."""
    share = np.zeros(len(strings), np.uint16)
    for i in range(1, len(strings)):
        share[i] = shared_prefix(strings[i - 1], strings[i])
    rests = [s[k:] for s, k in zip(strings, share.tolist(), strict=True)]
    return share.tobytes(), np.array([len(r) for r in rests], np.uint16).tobytes(), b"".join(rests)


class Run:
    """Reads a front-coded run string by string; only the current string is whole."""

    def __init__(self, share: bytes, size: bytes, rest: bytes) -> None:
        self.share = np.frombuffer(share, np.uint16).tolist()
        self.size = np.frombuffer(size, np.uint16).tolist()
        self.rest, self.place, self.index, self.text = rest, 0, -1, b""

    def next(self) -> int:
        """Move on; returns the prefix shared with the string before, or -1 at the end."""
        self.index += 1
        if self.index >= len(self.share):
            self.text = None
            return -1
        keep, n = self.share[self.index], self.size[self.index]
        self.text = self.text[:keep] + self.rest[self.place : self.place + n]
        self.place += n
        return keep


def merge(runs: list[Run]):
    """(run, its index, prefix shared with the string before) in sorted order over all runs.

    A loser tree: ``known[r]`` is what the head of run r shares with the last winner. The head
    with the longer known prefix is the smaller one; only equal prefixes are compared, from
    there on. An ended run has known prefix -1 and loses against all others.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    known = [r.next() for r in runs] + [-1] * (leaves - len(runs))
    heads = [r.text for r in runs] + [None] * (leaves - len(runs))
    loser = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's known prefix becomes what it shares with the winner."""
        if known[a] > known[b]:
            return a, b
        if known[a] < known[b]:
            return b, a
        if known[a] < 0:
            return a, b
        x, y = heads[a], heads[b]
        share = shared_prefix(x, y, known[a])
        if x[share : share + 1] <= y[share : share + 1]:
            known[b] = share
            return a, b
        known[a] = share
        return b, a

    winners = list(range(leaves))
    at = leaves
    while len(winners) > 1:
        at //= 2
        above = []
        for i in range(0, len(winners), 2):
            won, lost = play(winners[i], winners[i + 1])
            loser[at + i // 2] = lost
            above.append(won)
        winners = above
    best = winners[0]
    while known[best] >= 0:
        yield best, runs[best].index, known[best]
        known[best] = runs[best].next()
        heads[best] = runs[best].text
        node = (best + leaves) // 2
        while node:
            best, loser[node] = play(best, loser[node])
            node //= 2


def suffixes(text: bytes, at: int, lo: int, hi: int, length: int) -> tuple[bytes, bytes]:
    """Right and left suffix of an anchor, told apart by their first byte."""
    gram = gram_size(length)
    return b"R" + text[at : hi + length], b"L" + text[lo : at + gram][::-1]


def borders(chosen: DataFrame, count: int, length: int) -> list[bytes]:
    """At most MAX_SAMPLES sampled suffixes cut the suffixes into ranges of like size.

    A border is a whole suffix, so that suffixes of a common passage are divided where they differ.
    """
    ranges = max(1, -(-2 * count // RANGE))
    if ranges == 1:
        return []
    wanted = min(ranges * SAMPLES, MAX_SAMPLES)
    ranges = min(ranges, max(wanted // 4, 1))

    def run(batches):
        for batch in texts.slices(batches):
            out = []
            for row in batch.to_pylist():
                text = row["text"].encode()
                for e in row["own"]:
                    out += suffixes(text, e["at"], e["lo"], e["hi"], length)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["s"])

    part = min(1.0, wanted / max(2 * count, 1))
    few = chosen.select(
        "text", F.filter("own", lambda e: F.pmod(F.xxhash64(e["at"], F.col("rid")), F.lit(1 << 20)) < int(part * (1 << 20)) + 1).alias("own")
    ).where(F.size("own") > 0)
    sample = sorted(r["s"] for r in few.mapInArrow(run, "s binary").limit(4 * MAX_SAMPLES).collect())
    if not sample:
        return []
    cut = {sample[len(sample) * i // ranges] for i in range(1, ranges)}
    return sorted(bytes(x) for x in cut)


def sorted_runs(chosen: DataFrame, cuts: list[bytes], length: int) -> DataFrame:
    """Front-coded pieces of sorted runs, by range: bucket, run data, and who the strings belong to.

    No border divides equal suffixes. Those that are equal within a run are settled there: they
    go to a bucket of their own beyond the ranges, and their range gets the string without owners.
    """
    least = 1 + gram_size(length)
    schema = (
        "bucket int, share binary, size binary, rest binary, ghost binary, refs binary, rid binary, at binary"
    )

    def pieces(held: dict[bytes, list[tuple[int, int]]]):
        strings = sorted(held)
        ends = [bisect.bisect_left(strings, c) for c in cuts]
        edges = [0, *ends, len(strings)]
        made: list[tuple] = []

        def add(bucket: int, own: list[bytes], ghost: list[int]) -> None:
            refs = [[] if g else held[s] for s, g in zip(own, ghost, strict=True)]
            flat = [r for rs in refs for r in rs]
            made.append((
                bucket, *front_coded(own), bytes(ghost),
                np.array([len(r) for r in refs], np.int32).tobytes(),
                np.array([r[0] for r in flat], np.int64).tobytes(),
                np.array([r[1] for r in flat], np.int32).tobytes(),
            ))

        equal = [s for s in strings if len(held[s]) > 1]
        if equal and cuts:
            rid, at = held[equal[0]][0]
            add(len(edges) - 1 + zlib.crc32(f"{rid},{at}".encode()) % (1 << 30), equal, [0] * len(equal))
        for bucket in range(len(edges) - 1):
            own = strings[edges[bucket] : edges[bucket + 1]]
            ghost = [int(bool(cuts) and len(held[s]) > 1) for s in own]
            # Neighbours across a border count only if they share a gram with the border.
            if bucket and edges[bucket]:
                near = strings[edges[bucket] - 1]
                if shared_prefix(near, cuts[bucket - 1]) >= least:
                    own, ghost = [near, *own], [1, *ghost]
            if bucket < len(cuts) and edges[bucket + 1] < len(strings):
                near = strings[edges[bucket + 1]]
                if shared_prefix(near, cuts[bucket]) >= least:
                    own, ghost = [*own, near], [*ghost, 1]
            if own:
                add(bucket, own, ghost)
        columns = [pa.array([m[0] for m in made], pa.int32())]
        columns += [pa.array([m[i] for m in made], pa.binary()) for i in range(1, 8)]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(", ")])

    def run(batches):
        held: dict[bytes, list[tuple[int, int]]] = {}
        n = 0
        for batch in texts.slices(batches):
            for row in batch.to_pylist():
                text, rid = row["text"].encode(), row["rid"]
                for e in row["own"]:
                    for s in suffixes(text, e["at"], e["lo"], e["hi"], length):
                        held.setdefault(s, []).append((rid, e["at"]))
                    n += 2
                    if n >= RUN:
                        yield pieces(held)
                        held, n = {}, 0
        if held:
            yield pieces(held)

    return chosen.select("rid", "text", "own").mapInArrow(run, schema)


def merged(pieces: DataFrame, ranges: int, length: int) -> DataFrame:
    """(rid, at, side, reach): the longest prefix an anchor's suffix shares with another one."""
    least = 1 + gram_size(length)
    names = ["rid", "at", "side", "reach"]

    def bucket(rows: list[dict]):
        runs = [Run(r["share"], r["size"], r["rest"]) for r in rows]
        ghost = [r["ghost"] for r in rows]
        begin = [np.concatenate([[0], np.cumsum(np.frombuffer(r["refs"], np.int32))]) for r in rows]
        rid = [np.frombuffer(r["rid"], np.int64) for r in rows]
        at = [np.frombuffer(r["at"], np.int32) for r in rows]
        out: list[tuple] = []
        last = None  # (run, index, side, its length, what it shares with the one before)

        def close(next_share: int) -> None:
            k, i, side, size, share = last
            if ghost[k][i]:
                return
            a, b = begin[k][i], begin[k][i + 1]
            reach = size if b - a > 1 else max(share, next_share)
            if reach >= least:
                out.extend((int(rid[k][j]), int(at[k][j]), side, reach) for j in range(a, b))

        for k, i, share in merge(runs):
            if last is not None:
                close(share)
            text = runs[k].text
            last = (k, i, text[0], len(text), share)
            if len(out) > 50_000:
                yield out
                out = []
        if last is not None:
            close(0)
        yield out

    def run(batches):
        def whole():
            held: list[dict] = []
            for batch in batches:
                for row in batch.to_pylist():
                    if held and held[0]["bucket"] != row["bucket"]:
                        yield held
                        held = []
                    held.append(row)
            if held:
                yield held

        for rows in whole():
            for out in bucket(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in
                     enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                    names=names,
                )

    placed = pieces.repartition(max(ranges, 1), "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(run, "rid bigint, at int, side int, reach int")


# --- from reaches to repeated starts -----------------------------------------------------------


def _looked_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key occurs twice or more."""
    twice = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").select(*keys)
    return rows.join(twice.hint("rebalance"), keys, "left_semi")


def _one_each(rows: DataFrame, group: str, key: list[str], columns: list[str]) -> DataFrame:
    """One row per key, of the groups that hold different keys."""
    mixed = rows.groupBy(group).agg(*(f(k).alias(f"{n}_{k}") for k in key for n, f in (("a", F.min), ("b", F.max))))
    differ = F.lit(False)
    for k in key:
        differ = differ | (F.col(f"a_{k}") != F.col(f"b_{k}"))
    one = rows.groupBy(group, *key).agg(F.min(F.struct(*columns)).alias("_one"))
    mixed = mixed.where(differ).select(group).hint("rebalance")
    return one.join(mixed, group, "left_semi").select("_one.*")


def _fingerprints(data: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    return (
        texts.mix(texts.ranged(texts.prefix(data), lo, hi)).view(np.int64),
        texts.mix(texts.ranged(second(data), lo, hi)).view(np.int64),
    )


def _prints(rows: DataFrame, length: int, single: bool) -> DataFrame:
    """Fingerprints of each range of starts: of the whole string over them, or of every window."""
    names = ["rid", "at", "lo", "hi", "gram", "f1", "f2"]
    gram = gram_size(length)

    def run(batches):
        for batch in texts.slices(batches):
            parts = []
            for row in batch.to_pylist():
                data = np.frombuffer(row["text"].encode(), np.uint8)
                at, lo, hi = (np.array([e[c] for e in row["todo"]], np.int64) for c in ("at", "lo", "hi"))
                if single:
                    n = hi - lo + 1
                    at = np.repeat(at, n)
                    lo = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                    hi = lo
                grams = texts.mix(texts.ranged(texts.prefix(data), at, at + gram)).view(np.int64)
                f1, f2 = _fingerprints(data, lo, hi + length)
                parts.append((np.full(len(at), row["rid"]), at, lo, hi, grams, f1, f2))
            kinds = [pa.int64()] + [pa.int32()] * 3 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([p[i] for p in parts]), t) for i, t in enumerate(kinds)],
                names=names,
            )

    schema = "rid bigint, at int, lo int, hi int, gram bigint, f1 bigint, f2 bigint"
    return rows.select("rid", "text", "todo").mapInArrow(run, schema)


def _todo(kept: DataFrame, ranges: DataFrame) -> DataFrame:
    """Texts with their ranges of starts; a text has at most as many ranges as anchors."""
    listed = ranges.groupBy("rid").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("todo"))
    return kept.select("rid", "text").join(listed, "rid")


def found(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(texts that may hold a repeated window: rid, text; ranges of repeated starts: rid, lo, hi)."""
    rows = texts.with_row_id(docs.select("text"))
    every = texts.stored(anchors(rows, length), "anchors")
    again = every.groupBy("gram").agg(F.count("*").alias("_n")).where("_n > 1").select("gram")
    # Dealt out anew before the join, so that AQE can split a gram that many texts share. The rows
    # that stay are dealt by text, so that each file, and so each task of the next shuffle, holds a part of a hot block.
    few = every.join(again.hint("rebalance"), "gram", "left_semi").repartition("rid")
    few = texts.stored(few, "repeated-anchors")
    blocks = few.groupBy("gram", "block").agg(
        F.count("*").alias("_n"), F.min(F.struct("rid", "at", "lo", "hi")).alias("_one")
    )
    blocks = texts.stored(blocks, "repeated-blocks")
    twice = blocks.where("_n > 1").select("gram", "block").hint("rebalance")
    whole = few.join(twice, ["gram", "block"], "left_semi")
    mixed = blocks.groupBy("gram").agg(F.count("*").alias("_k")).where("_k > 1").select("gram")
    # Of each distinct block one occurrence is sorted; equal blocks are settled already.
    one = blocks.join(mixed.hint("rebalance"), "gram", "left_semi").select("_one.*")
    listed = (
        one.select("rid", F.struct("at", "lo", "hi").alias("e"), F.lit(None).cast("struct<lo:int,hi:int>").alias("w"))
        .unionByName(whole.select("rid", F.lit(None).cast("struct<at:int,lo:int,hi:int>").alias("e"),
                                  F.struct("lo", "hi").alias("w")))
        .groupBy("rid")
        .agg(F.collect_list("e").alias("own"), F.collect_list("w").alias("whole"))
    )
    texted = rows.select(F.col("_rid").alias("rid"), "text")
    kept = texts.stored(texted.join(listed, "rid"), "repeat-texts")
    chosen = kept.where(F.size("own") > 0)
    count = chosen.agg(F.sum(F.size("own"))).first()[0] or 0
    sure = kept.select("rid", F.explode("whole").alias("w")).select("rid", "w.lo", "w.hi")
    if not count:
        return kept, sure
    cuts = borders(chosen, count, length)
    reach = merged(sorted_runs(chosen, cuts, length), len(cuts) + 1, length)
    gram = gram_size(length)
    sides = reach.groupBy("rid", "at").agg(
        F.max(F.when(F.col("side") == ord("R"), F.col("reach") - 1)).alias("right"),
        F.max(F.when(F.col("side") == ord("L"), F.col("reach") - 1 - gram)).alias("left"),
    )
    sides = sides.where(F.col("right") + F.col("left") >= length)
    own = chosen.select("rid", F.explode("own").alias("e")).select("rid", "e.at", "e.lo", "e.hi")
    open_ = own.join(sides, ["rid", "at"]).select(
        "rid", "at",
        F.greatest("lo", F.col("at") - F.col("left")).alias("lo"),
        F.least("hi", F.col("at") + F.col("right") - length).alias("hi"),
    ).where("lo <= hi")
    strings = texts.stored(_prints(_todo(chosen, open_), length, single=False), "repeat-strings")
    sure = sure.unionByName(_looked_up(strings, ["gram", "f1", "f2"]).select("rid", "lo", "hi"))
    left = _one_each(strings, "gram", ["f1"], ["rid", "at", "lo", "hi"])
    windows = texts.stored(_prints(_todo(chosen, left), length, single=True), "repeat-windows")
    return kept, sure.unionByName(_looked_up(windows, ["f1", "f2"]).select("rid", "lo", "hi"))


def _removed(ranges: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal removed runs from ranges of repeated starts."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] + length) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Changed texts only: rid, n_removed, n_spans, kept_sha256 and the text that stays.

    The digest is over the bytes that stay; the text leaves out characters that were cut.
    """
    kept, ranges = found(docs, length)
    listed = ranges.groupBy("rid").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    schema = "rid bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"

    def run(batches):
        for batch in texts.slices(batches):
            out = []
            for row in batch.to_pylist():
                text, gone = row["text"].encode(), _removed(row["ranges"], length)
                edge = [0, *(x for r in gone for x in r), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True))
                out.append((
                    row["rid"], len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(),
                    rest.decode("utf-8", "ignore"),
                ))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                names=[c.split()[0] for c in schema.split(", ")],
            )

    return kept.select("rid", "text").join(listed, "rid").mapInArrow(run, schema)


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Removed bytes, spans and digest of what stays, for every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = texts.with_row_id(docs.select("doc_id", "text"), "rid").select(
        "rid", F.col("doc_id").cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("_all"),
    )
    changed = removals(docs, length).drop("kept")
    return rows.join(changed, "rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "_all").alias("kept_sha256"),
    )


def strip(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated bytes removed; all rows and columns stay.

    A character that a removal cut in two is dropped with it, so that texts stay valid.
    """
    rid, new = texts.free_name(docs, "_rid"), texts.free_name(docs, "_new")

    changed = removals(docs, length).select(F.col("rid").alias(rid), F.col("kept").alias(new))
    rows = texts.with_row_id(docs, rid).join(changed, rid, "left")
    return rows.select(
        *(F.coalesce(new, c).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns)
    )
