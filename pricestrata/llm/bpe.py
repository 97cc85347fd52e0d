"""BPE encoding and decoding by a trie over distinct words.

A word's encoding is determined from left to right: among the tokens that end a prefix there is
exactly one that fits behind the encoding of what precedes it. So each trie node needs one
state, the last token of its prefix, found from the states on the path above it. Distinct words
are inserted into a trie, a depth-first walk sets the state of each node once, and words with
a common prefix share that work. Reading the states back from a word's end gives its tokens.

Two neighbouring tokens fit if no merge rule joins them across their border before each of them is
complete; ``Merges.fits`` follows the right edge of the one and the left edge of the other.

Words come from the texts of a slice; what was encoded before is kept in a table of bounded
size per Python worker, which changes the speed only.

Defined results
- null or empty text: no tokens, both digests are those of the empty string.
- special tokens written out in a text become their ids, as in the tokenizers library.
- null doc_id is kept; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts

END = "</w>"
#: Words kept encoded per Python worker.
TABLE_WORDS = 600_000
#: Token pairs whose fit is kept per Python worker.
TABLE_PAIRS = 1_000_000
_NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable stand-in of each byte, by the byte-level rule: printable Latin-1 bytes stand for
    themselves, the others are numbered from 256 in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Merges:
    """Vocabulary and merge rules, with the test whether two tokens may stand side by side."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]]) -> None:
        self.id = vocab
        self.token = {i: t for t, i in vocab.items()}
        self.rule: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            pair = vocab[a], vocab[b]
            self.rule.setdefault(pair, rank)
            self.made.setdefault(vocab[a + b], (rank, *pair))
        #: Every string that some token ends with.
        self.tails = {t[i:] for t in vocab for i in range(len(t))}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}

    def _edge(self, token: int, side: int, kept: dict) -> list[tuple[int, int]]:
        """(token, rank that made it) along one edge, smallest first, closed by a sentinel."""
        found = kept.get(token)
        if found is None:
            found, at = [], token
            while at in self.made:
                found.append((at, self.made[at][0]))
                at = self.made[at][side]
            found.append((at, -1))
            found.reverse()
            found.append((-1, _NEVER))
            kept[token] = found
        return found

    def fits(self, first: int, second: int) -> bool:
        key = first << 32 | second
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= TABLE_PAIRS:
                self._fits.clear()
            known = self._fits[key] = self._apart(first, second)
        return known

    def _apart(self, first: int, second: int) -> bool:
        right, left = self._edge(first, 2, self._right), self._edge(second, 1, self._left)
        i = j = 0
        while right[i][0] >= 0 and left[j][0] >= 0:
            (x, born_x), (y, born_y) = right[i], left[j]
            gone_x, gone_y = right[i + 1][1], left[j + 1][1]
            rank = self.rule.get((x, y))
            if rank is not None:
                when = max(rank, born_x, born_y)
                # Of two uses of one rule the left one comes first.
                if when < gone_x and (when < gone_y or rank == gone_y):
                    return False
            if gone_x == gone_y == _NEVER:
                return True
            if gone_x <= gone_y:
                i += 1
            else:
                j += 1
        return True


class Trie:
    """Distinct words by shared prefixes; ``encode`` walks it depth first."""

    def __init__(self, merges: Merges, words: Iterable[str]) -> None:
        self.merges = merges
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, str] = {}
        for word in words:
            node = 0
            for letter in word:
                below = self.children[node]
                node = below.get(letter)
                if node is None:
                    node = below[letter] = len(self.children)
                    self.children.append({})
            self.ends[node] = word

    def encode(self) -> dict[str, list[int]]:
        """Tokens of every inserted word.

        ``last[d]`` is (token, its letters) of the prefix of d letters on the current path; a
        node is visited right after its ancestors, so the states above it are its own.
        """
        vocab, fits, tails = self.merges.id.get, self.merges.fits, self.merges.tails
        out: dict[str, list[int]] = {}
        last: list = [(0, 0)]

        def state(prefix: str, depth: int, suffix: str) -> tuple[int, int]:
            whole = prefix + suffix
            fit: list[tuple[int, int]] = []
            for at in range(depth - 1, -1, -1):
                tail = whole[at:]
                if tail not in tails:
                    break
                token = vocab(tail)
                if token is not None:
                    fit.append((token, at))
            # Long tokens fit more often; exactly one does.
            for token, at in reversed(fit):
                if not at or fits(last[at][0], token):
                    return token, depth - at
            raise ValueError(f"no token ends {prefix!r}")

        stack = [(0, "")]
        while stack:
            node, prefix = stack.pop()
            depth = len(prefix)
            below = self.children[node]
            if node in self.ends:
                token, size = state(prefix, depth, END)
                ids, at = [token], depth - size
                while at:
                    token, size = last[at]
                    ids.append(token)
                    at -= size
                ids.reverse()
                out[self.ends[node]] = ids
            if below:
                if depth:
                    del last[depth:]
                    last.append(state(prefix, depth, ""))
                for letter, child in below.items():
                    stack.append((child, prefix + letter))
        return out


class Coder:
    """A tokenizer file with word-end BPE: texts to ids and back."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model.get("end_of_word_suffix") != END:
            raise ValueError("not a vocabulary with word ends")
        self.merges = Merges(model["vocab"], (tuple(m) for m in model["merges"]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = self.merges.token | {i: t for t, i in self.special.items()}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = texts.Splitter(pattern)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = byte_letters()
        #: Word to (ids joined by spaces, names of the tokens joined by spaces).
        self.table: dict[str, tuple[str, str]] = {}

    def normal(self, text: str) -> str:
        """NFC, then lower case letter by letter: a capital sigma has one lower form."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:
                text = text.replace("Σ", "σ")
        return text.lower()

    def learn(self, words: set[str]) -> None:
        """Encode words that the table lacks, through one trie, and add them to it."""
        letters, token = self.letters, self.merges.token
        spelled = {}
        for w in words:
            if w[0] == " ":
                self.table[w] = str(self.special[w[1:]]), w[1:]
            elif w.isascii() and w.isprintable():
                spelled[w] = w
            else:
                spelled[w] = "".join([letters[b] for b in w.encode()])
        found = Trie(self.merges, spelled.values()).encode()
        for word, spelling in spelled.items():
            ids = found[spelling]
            self.table[word] = " ".join(map(str, ids)), " ".join([token[i] for i in ids])

    def pieces(self, text: str) -> list[str]:
        """Words of a text; a special token is a piece of its own, marked by a leading space."""
        if not any(s in text for s in self.special):
            return self.words(self.normal(text))
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(" " + part)
            else:
                out += self.words(self.normal(part))
        return out

    def code(self, rows: list[str]) -> list[tuple[str, str]]:
        """(ids joined by spaces, decoded text) of each text."""
        split = [self.pieces(x) for x in rows]
        found = [list(map(self.table.get, p)) for p in split]
        fresh: set[str] = set()
        for p, f in zip(split, found, strict=True):
            if None in f:
                fresh.update(x for x, y in zip(p, f, strict=True) if y is None)
        if len(self.table) + len(fresh) > TABLE_WORDS:
            self.table.clear()
            fresh = {x for p in split for x in p}
        self.learn(fresh)
        known, out = self.table.__getitem__, []
        for p, f in zip(split, found, strict=True):
            if None in f:
                f = list(map(known, p))
            out.append((" ".join([x[0] for x in f]), " ".join([x[1] for x in f])))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join([self.names[i] for i in ids])


_CODERS: dict[str, Coder] = {}
texts.TABLES.append(_CODERS)


def coder(path: str) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode_decode(docs: DataFrame, path: str, keep: bool = False) -> DataFrame:
    """Counts and digests per document; ``keep`` adds the ids and the decoded text themselves.

    ``path``: the tokenizer file, at the same place on every machine.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" if keep else ""

    def run(batches):
        own = coder(path)
        for batch in texts.slices(batches, limit=texts.CODED_BYTES):
            made = own.code([x or "" for x in batch.column("text").to_pylist()])
            columns = [
                batch.column("doc_id"),
                pa.array([i.count(" ") + 1 if i else 0 for i, _ in made], pa.int64()),
                pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _ in made], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for _, d in made], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep:
                ids = [[int(x) for x in i.split()] for i, _ in made]
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array([d for _, d in made], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)
