"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

Items are normalised to words; the automaton over their word sequences accepts every run of
words that occurs in some item. A document's words are streamed through it, and at each word the
longest run that ends there and occurs in an item is known. Where that length reaches the
window, the window's words are hit. An item with fewer words than the window is a window itself:
its occurrence is seen at the state where the whole item ends.

Before the walk, pairs of neighbouring words are looked up in a bit table of the items' pairs:
a run of two or more words can only go on where each pair is in the table, so stretches that
could not reach the shortest window are skipped. The table may let through too much, never too
little.

The items are the broadcast side, in blocks of about ``BLOCK_WORDS`` words at most: items are cut
into parts that overlap by a window less one word, so every window lies in one part, and parts
are dealt to blocks by hash. The driver builds one automaton per block, one after the other.
With several blocks each one walks all documents and gives hit words and items per document row;
these are united per row before anything is counted or removed, so results do not depend on
the number of blocks. ``docs`` must then be a stored table (see texts.with_row_id).

Defined results
- null or empty text: no words, not contaminated. Null or empty items have no windows.
- an item_id that is null counts under the empty name; repeated item rows count once.
- null doc_id is kept; repeated documents give repeated results; extra columns are ignored.
- no items: nothing is hit.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts

WINDOW = 10
#: Words in one block: an automaton takes about 0.8 KB a word in the driver and in each worker.
BLOCK_WORDS = 400_000
#: Words of an item in one part.
PART_WORDS = 10_000
#: A document of which more than this share of the words is hit is dropped by ``clean``.
MAX_COVERAGE = 0.5
BITS = 22
_U = np.uint64

#: Bytes of words: digits, lower-case letters and everything beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def lowered(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return np.where(upper, data + 32, data).astype(np.uint8)


def _pairs(code: np.ndarray) -> np.ndarray:
    """Bit table index of each pair of neighbouring words."""
    return (texts.mix(code[:-1] * _U(0x9E3779B97F4A7C15) + code[1:]) >> _U(64 - BITS)).astype(np.int64)


@dataclass
class Automaton:
    """States of a generalised suffix automaton over word numbers."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: Items whose words reach a state; after ``close`` of every state as long as the window.
    items: list[set[str]] = field(default_factory=lambda: [set()])
    #: Whole short items by the state in which they end.
    short: dict[int, list[tuple[int, str]]] = field(default_factory=dict)
    shortest: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, bool))
    singles: bool = False

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.items.append(set())
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            known = step[last][word]
            if length[known] == length[last] + 1:
                return known
            return self._split(last, word, known)
        new = self._state(length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            known = step[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._split(at, word, known)
        return new

    def _split(self, at: int, word: int, known: int) -> int:
        """A state of its own for the shorter runs of ``known``."""
        copy = self._state(self.length[at] + 1, self.link[known], dict(self.step[known]))
        self.link[known] = copy
        while at >= 0 and self.step[at].get(word) == known:
            self.step[at][word] = copy
            at = self.link[at]
        return copy

    def add(self, item: str, words: list[bytes]) -> None:
        if not words:
            return
        last = 0
        for w in words:
            last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
            self.items[last].add(item)
        self.shortest = min(self.shortest or self.window, len(words), self.window)
        self.singles |= len(words) == 1

    def close(self, rows: list[tuple[str, list[bytes]]]) -> None:
        """Spread item names to shorter runs; find where short items end."""
        for s in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.length[self.link[s]] >= self.window:
                self.items[self.link[s]] |= self.items[s]
        for item, words in rows:
            if 0 < len(words) < self.window:
                at = 0
                for w in words:
                    at = self.step[at][self.vocabulary[w]]
                if (len(words), item) not in self.short.setdefault(at, []):
                    self.short[at].append((len(words), item))

    def walk(self, words: list[bytes], hit: np.ndarray, base: int, found: set[str]) -> None:
        """Stream words; mark hit words from ``base`` on and collect the items found."""
        step, link, length, window = self.step, self.link, self.length, self.window
        number, state, run = self.vocabulary.get, 0, 0
        for i, w in enumerate(words):
            k = number(w)
            if k is None:
                state = run = 0
                continue
            while state and k not in step[state]:
                state = link[state]
                run = length[state]
            state = step[state].get(k, 0)
            run = run + 1 if state else 0
            if run >= window:
                hit[base + i - window + 1 : base + i + 1] = True
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                found |= self.items[at]
            if self.short:
                at = state
                while at > 0:
                    for n, item in self.short.get(at, ()):
                        if n <= run:
                            hit[base + i - n + 1 : base + i + 1] = True
                            found.add(item)
                    at = link[at]


def normalised(text: str) -> list[bytes]:
    data, offsets = texts.utf8(pa.array([text]))
    data = lowered(data)
    starts, ends, _ = texts.spans(WORD[data], offsets)
    return [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]


def parts(items: DataFrame, window: int) -> DataFrame:
    """(item, words, n): normalised items, long ones in overlapping parts with all windows."""
    rows = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )

    def run(batches):
        for batch in texts.slices(batches):
            out = []
            for row in batch.to_pylist():
                words = normalised(row["text"])
                # The last part starts where a whole window is left; a shorter item is one part.
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), PART_WORDS):
                    own = words[at : at + PART_WORDS + window - 1]
                    out.append((row["item"], b" ".join(own).decode(), len(own)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["item", "words", "n"],
            )

    return rows.mapInArrow(run, "item string, words string, n bigint")


def blocks(items: DataFrame, window: int = WINDOW) -> list:
    """Broadcast automata that hold all items together; one if BLOCK_WORDS words are enough."""
    spark = items.sparkSession
    cut = texts.stored(parts(items, window), "item-parts")
    total = cut.agg(F.sum("n")).first()[0] or 0
    # Room for blocks that the hash makes larger than others.
    count = 1 if total <= BLOCK_WORDS else -(-4 * total // (3 * BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item", "words"), F.lit(count))
    made = []
    for b in range(count):
        rows = cut.where(block == b).select("item", "words").collect()
        made.append(spark.sparkContext.broadcast(build(rows, window)))
    return made


def build(rows: list, window: int = WINDOW) -> Automaton:
    """The automaton of one block of parts."""
    # In a fixed order, so that every run builds the same automaton.
    split = [(item, words.encode().split(b" ")) for item, words in sorted({(r[0], r[1]) for r in rows})]
    made = Automaton(window)
    for item, words in split:
        made.add(item, words)
        data = np.frombuffer(b" ".join(words), np.uint8)
        starts, ends, _ = texts.spans(WORD[data], np.array([0, len(data)]))
        made.pairs[_pairs(texts.mix(texts.ranged(texts.prefix(data), starts, ends)))] = True
    made.close(split)
    return made


def stretches(known: Automaton, code: np.ndarray, before: np.ndarray):
    """(text, first word, end word) of the stretches that may hold a window."""
    need = max(known.shortest - 1, 1)
    if len(code) < 2:
        return
    good = known.pairs[_pairs(code)]
    inner = before[1:-1]
    inner = inner[(inner > 0) & (inner < len(code))]
    good[inner - 1] = False  # the last word of one text and the first of the next
    edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = end - first >= need
    owner = np.searchsorted(before, first, "right") - 1
    yield from zip(owner[keep].tolist(), first[keep].tolist(), (end[keep] + 1).tolist(), strict=True)


def hits(known: Automaton | None, column: pa.Array):
    """(bytes, offsets, word starts, word ends, words before each text, hit words, items).

    Without an automaton nothing is hit yet.
    """
    data, offsets = texts.utf8(column)
    low = lowered(data)
    starts, ends, before = texts.spans(WORD[low], offsets)
    hit = np.zeros(len(starts), bool)
    found: dict[int, set[str]] = {}
    if known is not None and known.shortest:
        if known.singles:
            # A one-word item can stand anywhere: every text is walked whole.
            todo = ((i, before[i], before[i + 1]) for i in range(len(offsets) - 1))
        else:
            code = texts.mix(texts.ranged(texts.prefix(low), starts, ends))
            todo = stretches(known, code, before)
        for i, a, b in todo:
            own: set[str] = set()
            words = [low[x:y].tobytes() for x, y in zip(starts[a:b], ends[a:b], strict=True)]
            known.walk(words, hit, a, own)
            if own:
                found.setdefault(i, set()).update(own)
    return data, offsets, starts, ends, before, hit, found


def united(docs: DataFrame, made: list) -> DataFrame:
    """The documents with a last column of what the blocks found: hit words from ``first`` to
    before ``end``, counted in the text, and items. It is null where nothing was found."""
    rid, found_in = texts.free_name(docs, "_rid"), texts.free_name(docs, "_found")
    rows = texts.with_row_id(docs, rid)
    schema = f"{rid} bigint, first array<int>, end array<int>, items array<string>"

    def walked(shared):
        def run(batches):
            known = shared.value
            for batch in texts.slices(batches):
                *_, before, hit, found = hits(known, batch.column("text"))
                first, end, owner = [], [], sorted(found)
                for i in owner:
                    a, b = before[i], before[i + 1]
                    x, y, _ = texts.spans(hit[a:b], np.array([0, b - a]))
                    first.append(x)
                    end.append(y)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(rid).take(pa.array(owner, pa.int64())),
                        pa.array(first, pa.list_(pa.int32())), pa.array(end, pa.list_(pa.int32())),
                        pa.array([sorted(found[i]) for i in owner], pa.list_(pa.string())),
                    ],
                    names=[rid, "first", "end", "items"],
                )

        return rows.select(rid, "text").mapInArrow(run, schema)

    every = walked(made[0])
    for shared in made[1:]:
        every = every.unionByName(walked(shared))
    # A text has at most one row of a block.
    one = every.groupBy(rid).agg(F.struct(
        F.flatten(F.collect_list(F.struct("first", "end"))["first"]).alias("first"),
        F.flatten(F.collect_list(F.struct("first", "end"))["end"]).alias("end"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    ).alias(found_in))
    return rows.join(one, rid, "left").select(*(F.col(f"`{c}`") for c in docs.columns), found_in)


def _walk(docs: DataFrame, items: DataFrame, window: int):
    """(documents, function that gives ``hits`` of a batch of them)."""
    made, at = blocks(items, window), docs.columns.index("text")
    if len(made) == 1:
        shared = made[0]
        return docs, lambda batch: hits(shared.value, batch.column(at))

    def read(batch):
        *rest, before, hit, _ = hits(None, batch.column(at))
        found = {}
        for i, own in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if own:
                found[i] = set(own["items"])
                for x, y in zip(own["first"], own["end"], strict=True):
                    hit[before[i] + x : before[i] + y] = True
        return *rest, before, hit, found

    return united(docs, made), read


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Hit words and items of every whole document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows, walk = _walk(rows, items, window)
    schema = (
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
        "contaminated boolean"
    )

    def run(batches):
        for batch in texts.slices(batches):
            *_, before, hit, found = walk(batch)
            n_hit = texts.sums_by_text(hit, before)
            names = [",".join(sorted(found.get(i, ()))) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(before)), pa.array(n_hit),
                    pa.array([len(found.get(i, ())) for i in range(batch.num_rows)], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in names], pa.string()),
                    pa.array(n_hit > 0),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return rows.mapInArrow(run, schema)


def clean(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """The documents without their hit stretches, all columns kept.

    A maximal run of hit words goes from its first byte to its last, so words of two stretches
    never meet without a separator. A document whose hit words exceed ``max_coverage`` of all
    its words is dropped whole. Texts without a hit stay as they are, null included.
    """
    rows, walk = _walk(docs, items, window)
    at, width = docs.columns.index("text"), len(docs.columns)

    def run(batches):
        for batch in texts.slices(batches):
            column = batch.column(at)
            data, offsets, starts, ends, before, hit, found = walk(batch)
            n_hit, n_words = texts.sums_by_text(hit, before), np.diff(before)
            kept = n_hit <= max_coverage * n_words
            new = column.to_pylist()
            for i in found:
                if not kept[i]:
                    continue
                a, b = before[i], before[i + 1]
                first, last, _ = texts.spans(hit[a:b], np.array([0, b - a]))
                out, done = [], offsets[i]
                for x, y in zip(first, last, strict=True):
                    out.append(data[done : starts[a + x]].tobytes())
                    done = ends[a + y - 1]
                out.append(data[done : offsets[i + 1]].tobytes())
                new[i] = b"".join(out).decode()
            columns = list(batch.columns)[:width]
            columns[at] = pa.array(new, pa.string())
            names = batch.schema.names[:width]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(kept))

    return rows.mapInArrow(run, docs.schema)
