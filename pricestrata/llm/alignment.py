"""Alignment of two tokenizers' tokens by lockstep merging of their byte offsets.

A text with a space before it is cut by tokenizer A (byte-level BPE) and by tokenizer B (pieces with
byte fallback). Byte offsets where tokens of both end are cuts; the tokens between two cuts are a group, and every A
token of a group is linked with every B token of it.

1. ``aligned`` walks all documents of a batch at once. A state vector holds an A and a B pointer
   per lane; a lane is a document or, of a longer one, ``LANE`` A tokens of it, so that one long text does not
   leave the others waiting. Each step compares the ends under all pointers, emits a cut where they
   are equal, moves the pointers of the lower ends, and drops lanes that are done. A lane may begin inside
   a group: a cut does not depend on where the group began, and groups are read from the cuts of all lanes
   in order. The links of a document are kept as its distinct id pairs with their numbers.
2. ``counts`` adds up how many documents hold a pair, and which pairs are the best of their A id.
3. ``scored`` looks the pairs up. The counts lie in the shared folder in blocks of about ``PAIRS`` pairs; each
   block is one pass over the stored pairs, whose tasks read that block, so neither a task nor the
   driver holds more of them than a block.

Defined results
- null or empty text, and a text that either tokenizer does not give back byte by byte (for instance one
  with U+2581): no tokens, zeros and an empty groups_sha256.
- special tokens written out in a text are plain text.
- repeated rows are documents of their own. Null doc_ids are kept. Extra columns are ignored.
- a group without cuts over a very long stretch is linked by distinct ids, so memory follows ids, not pairs of places.
- no rows: an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts, tokenfiles

#: A tokens of one lane.
LANE = 256
#: Links of a group that are written out place by place; larger groups go by distinct ids.
GROUP = 1_024
#: Pairs in a block of counts, about 17 bytes each in a task.
PAIRS = 2_000_000
#: Words that a worker remembers per tokenizer; longer ones than this many characters are not kept.
WORDS, LONGEST = 400_000, 100
_SPACED = re.compile(r" *[^ ]+| +$").findall


class Left(tokenfiles.Encoder):
    """Tokenizer A, with written-out special tokens as plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        # The byte that each letter of a token stands for: printable ones for themselves, the
        # others in order from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        vocabulary = self.tokenizer.get_vocab()
        made = [b""] * len(self.width)
        for token, i in vocabulary.items():
            made[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes = made

    def ids(self, rows: list[str]) -> list[np.ndarray]:
        if len(self.table) > WORDS:
            self.table.clear()
        return [np.frombuffer(x, self.type).astype(np.int64) for x in self.encode(rows)]


class Right:
    """Tokenizer B: pieces. No piece has a space after another character, so a text is encoded word
    by word, each with the spaces before it, and words are remembered."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        # A space alone is what the model adds to an empty text, of which it gives no pieces.
        space = self.model.piece_to_id("▁")
        self.by_word = space != self.model.unk_id() and not any("▁" in p.lstrip("▁") for p in pieces)
        self.space = np.array([space], np.int32).tobytes()
        self.table: dict[str, bytes] = {}

    def ids(self, rows: list[str]) -> list[np.ndarray]:
        """Ids of texts that begin with the space that the model adds."""
        if not self.by_word:
            return [np.array(x, np.int64) for x in self.model.encode([r[1:] for r in rows], num_threads=1)]
        words = [_SPACED(r) for r in rows]
        known = self.table
        if not known or len(known) > WORDS:
            known.clear()
            known[" "] = self.space
        fresh = [w for w in {w for own in words for w in own} if w not in known]
        made = self.model.encode([w[1:] for w in fresh], num_threads=1) if fresh else []
        new = {w: array("i", x).tobytes() for w, x in zip(fresh, made, strict=True)}
        known.update((w, x) for w, x in new.items() if len(w) <= LONGEST)
        out = []
        for own in words:
            raw = list(map(known.get, own))
            if None in raw:
                raw = [new[w] if x is None else x for w, x in zip(own, raw, strict=True)]
            out.append(np.frombuffer(b"".join(raw), np.int32).astype(np.int64))
        return out


class Tables:
    """Both tokenizers of a worker, with token bytes laid end to end and the texts of ids."""

    def __init__(self, left: str, right: str) -> None:
        self.left, self.right = Left(left), Right(right)
        self.flat, self.start, self.width = [], [], []
        for own in (self.left.bytes, self.right.bytes):
            width = np.array([len(b) for b in own], np.int64)
            self.flat.append(np.frombuffer(b"".join(own), np.uint8))
            self.width.append(width)
            self.start.append(np.cumsum(width) - width)
        self.base = len(self.right.bytes)
        self.names = [f"{i}{end}" for i in range(len(self.left.bytes)) for end in ",|"]
        self.names += [f"{i}{end}" for i in range(self.base) for end in ",;"]


_TABLES: dict[tuple[str, str], Tables] = {}
texts.TABLES.append(_TABLES)


def tables(left: str, right: str) -> Tables:
    if (left, right) not in _TABLES:
        _TABLES[left, right] = Tables(left, right)
    return _TABLES[left, right]


def ramp(count: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)


def cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, lane: int = LANE):
    """(A index, B index) of the tokens that end at a cut, in order.

    ``a_first`` holds the index of each document's first A token, and their number as last entry.
    Ends are counted over all documents; each document's last tokens end together.
    """
    count = np.diff(a_first)
    lanes = -(-count // lane)
    a = np.repeat(a_first[:-1], lanes) + ramp(lanes) * lane
    a_end = np.append(a[1:], a_first[-1]) if len(a) else a
    edge = np.append(0, a_ends)
    b = np.searchsorted(b_ends, edge[a], "right")
    b_end = np.searchsorted(b_ends, edge[a_end], "right")
    met_a, met_b = [], []
    going = (a < a_end) & (b < b_end)
    a, b, a_end, b_end = a[going], b[going], a_end[going], b_end[going]
    while len(a):
        x, y = a_ends[a], b_ends[b]
        cut = x == y
        met_a.append(a[cut])
        met_b.append(b[cut])
        a, b = a + (x <= y), b + (y <= x)
        going = (a < a_end) & (b < b_end)
        if not going.all():
            a, b, a_end, b_end = a[going], b[going], a_end[going], b_end[going]
    if not met_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.concatenate(met_a)
    order = np.argsort(at)
    return at[order], np.concatenate(met_b)[order]


def _given_back(known: Tables, side: int, ids: list[np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts the token bytes of one side give back."""
    flat, start, width = known.flat[side], known.start[side], known.width[side]
    ok = np.array([int(width[x].sum()) for x in ids], np.int64) == np.diff(offsets)
    some = [x for x, good in zip(ids, ok, strict=True) if good]
    if not some:
        return ok
    every = np.concatenate(some)
    size = width[every]
    built = flat[np.repeat(start[every], size) + ramp(size)]
    place = np.flatnonzero(ok)
    length = np.diff(offsets)[place]
    wanted = data[np.repeat(offsets[place], length) + ramp(length)]
    wrong = np.repeat(np.arange(len(place)), length)[built != wanted]
    ok[place[np.unique(wrong)]] = False
    return ok


def links(a_ids: np.ndarray, b_ids: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, owner: np.ndarray, base: int, docs: int):
    """(document, pair, number) of the distinct linked pairs, by document, and links per document.

    ``a_end`` and ``b_end`` bound the groups; a pair is the A id times ``base`` plus the B id.
    """
    a_from, b_from = np.append(0, a_end[:-1]), np.append(0, b_end[:-1])
    na, nb = a_end - a_from, b_end - b_from
    total = np.bincount(owner, na * nb, docs).astype(np.int64)
    small = np.flatnonzero(na * nb <= GROUP)
    n = (na * nb)[small]
    k, wide = ramp(n), np.repeat(nb[small], n)
    pair = a_ids[np.repeat(a_from[small], n) + k // wide] * base + b_ids[np.repeat(b_from[small], n) + k % wide]
    of, times = [np.repeat(owner[small], n)], [np.ones(len(pair), np.int64)]
    pairs = [pair]
    for g in np.flatnonzero(na * nb > GROUP).tolist():
        x, cx = np.unique(a_ids[a_from[g] : a_end[g]], return_counts=True)
        y, cy = np.unique(b_ids[b_from[g] : b_end[g]], return_counts=True)
        pairs.append((x[:, None] * base + y).ravel())
        times.append((cx[:, None] * cy).ravel())
        of.append(np.full(len(x) * len(y), owner[g]))
    pair, of, times = np.concatenate(pairs), np.concatenate(of), np.concatenate(times)
    order = np.lexsort((pair, of))
    pair, of, times = pair[order], of[order], times[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    return of[first], pair[first], np.add.reduceat(times, first) if len(first) else times, total


def aligned(docs: DataFrame, left: str, right: str, lane: int = LANE) -> DataFrame:
    """rid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and times of every document,
    stored; rid tells rows apart, pairs are the distinct linked id pairs, times how often."""
    schema = pa.schema([
        ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    ])

    def one(batch):
        known = tables(left, right)
        rows = batch.num_rows
        column = batch.column("text").to_pylist()
        place = [i for i, x in enumerate(column) if x]
        spaced = [" " + column[i] for i in place]
        data, offsets = texts.utf8(pa.array(spaced, pa.string()))
        a, b = known.left.ids(spaced), known.right.ids(spaced)
        ok = _given_back(known, 0, a, data, offsets) & _given_back(known, 1, b, data, offsets)
        keep = np.flatnonzero(ok).tolist()
        a, b = [a[i] for i in keep], [b[i] for i in keep]
        n = len(keep)
        count_a, count_b = (np.array([len(x) for x in s], np.int64) for s in (a, b))
        a_first, b_first = (np.append(0, np.cumsum(c)) for c in (count_a, count_b))
        out = {c: np.zeros(rows, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        digest = [""] * rows
        bounds, pair, times = np.zeros(rows + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if n:
            at = np.array([place[i] for i in keep])
            a_ids, b_ids = np.concatenate(a), np.concatenate(b)
            ca, cb = cuts(np.cumsum(known.width[0][a_ids]), np.cumsum(known.width[1][b_ids]), a_first, lane)
            owner = np.searchsorted(a_first, ca, "right") - 1
            of, pair, times, total = links(a_ids, b_ids, ca + 1, cb + 1, owner, known.base, n)
            out["n_a"][at], out["n_b"][at], out["n_links"][at] = count_a, count_b, total
            out["n_groups"][at] = np.bincount(owner, minlength=n)
            size = np.zeros(rows, np.int64)
            size[at] = np.bincount(of, minlength=n)
            bounds = np.append(0, np.cumsum(size))
            # Groups in order: the A tokens of one, its B tokens, the next.
            last_a, last_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
            last_a[ca], last_b[cb] = 1, 1
            group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
            code = np.empty(len(a_ids) + len(b_ids), np.int64)
            code[np.arange(len(a_ids)) + np.append(0, cb + 1)[group_a]] = 2 * a_ids + last_a
            code[np.arange(len(b_ids)) + (ca + 1)[group_b]] = 2 * (len(known.left.bytes) + b_ids) + last_b
            edge = a_first + b_first
            name = known.names.__getitem__
            for i, x, y in zip(at.tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                digest[i] = hashlib.sha256("".join(map(name, code[x:y].tolist()))[:-1].encode()).hexdigest()
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(v)) for v in (pair, times)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(v) for v in out.values()), pa.array(digest), *lists], schema=schema
        )

    def run(batches):
        for batch in texts.slices(batches, limit=texts.CODED_BYTES):
            yield one(batch)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, times array<bigint>",
    )
    # Written into the table, this number stays the row's own.
    return texts.stored(made.withColumn("rid", F.monotonically_increasing_id()), "aligned")


def counts(found: DataFrame, base: int) -> DataFrame:
    """(pair, a_id, b_id, n, best): the documents that hold a pair, and whether no other pair of its A id has more;
    stored."""
    pairs = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    pairs = texts.stored(
        pairs.select("pair", F.floor(F.col("pair") / base).alias("a_id"), (F.col("pair") % base).alias("b_id"), "n"), "pairs"
    )
    most = pairs.groupBy("a_id").agg(F.max("n").alias("most"))
    made = pairs.join(most, "a_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))
    return texts.stored(made, "pair-counts")


_BLOCK: dict[str, tuple[np.ndarray, ...]] = {}
texts.TABLES.append(_BLOCK)


def _block(path: str) -> tuple[np.ndarray, ...]:
    """(pairs, documents, best) of one block, by pair; a worker keeps one block."""
    import pyarrow.dataset as ds

    if path not in _BLOCK:
        _BLOCK.clear()
        files, at = tokenfiles._filesystem(path)
        own = ds.dataset(at, filesystem=files, format="parquet").to_table(["pair", "n", "best"])
        pair, n, best = (own.column(c).to_numpy() for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        _BLOCK[path] = pair[order], n[order], best[order]
    return _BLOCK[path]


def scored(found: DataFrame, known: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """(rid, n_best, count_sum) of the documents with links."""
    spark = found.sparkSession
    blocks = max(1, -(-known.count() // pairs))
    root = texts.shared_path(spark, "pair-blocks")

    def walked(k: int, path: str) -> DataFrame:
        def run(batches):
            pair, n, best = _block(path)
            for batch in batches:
                lists = [batch.column(batch.schema.get_field_index(c)) for c in ("pairs", "times")]
                size = np.diff(lists[0].offsets.to_numpy())
                own, times = (x.flatten().to_numpy() for x in lists)
                owner = np.repeat(np.arange(batch.num_rows), size)
                if blocks > 1:
                    here = own % blocks == k
                    own, times, owner = own[here], times[here], owner[here]
                at = np.searchsorted(pair, own)
                sums = [
                    np.bincount(owner, times * v[at], batch.num_rows).astype(np.int64) for v in (best, n)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rid"), *map(pa.array, sums)], names=["rid", "n_best", "count_sum"]
                )

        rows = found.where(F.size("pairs") > 0).select("rid", "pairs", "times")
        return rows.mapInArrow(run, "rid bigint, n_best bigint, count_sum bigint")

    every = None
    for k in range(blocks):
        path = f"{root}/{k}"
        known.where(F.col("pair") % blocks == k).write.parquet(path)
        every = walked(k, path) if every is None else every.unionByName(walked(k, path))
    return every.groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, left: str, right: str, lane: int = LANE, pairs: int = PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    from sentencepiece import SentencePieceProcessor

    found = aligned(docs, left, right, lane)
    known = counts(found, SentencePieceProcessor(model_file=right).get_piece_size())
    sums = scored(found, known, pairs)
    zero = F.lit(0).cast("bigint")
    return found.drop("pairs", "times").join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
