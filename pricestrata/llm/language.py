"""Language ID by rank-order profiles.

A profile is the ``size`` most frequent character n-grams (n = 1, 2, 3) of a language, counted
over every training text. A document is ranked the same way and compared with each profile: the
out-of-place distance adds, per n-gram of the document, how far its rank is from its rank in
the profile, or ``size`` where the profile lacks it. The language with the least distance wins, ties go to
the first name in alphabetical order. score = 1 - distance / (n-grams * size).

N-grams lie inside words: a text is lower-cased, cut into runs of letters, and each run is
padded with one mark on both sides.

Defined results
- null text, or text without a letter: ``und``, score 0; the same if nothing could be learned.
- a null doc_id counts as held out: it is never learned from.
- a null lang, or a held-out row, is never learned from; repeated rows count as often as they occur.
- documents without rows give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricestrata.llm import texts

SIZE = 300
FOLDS = 5
MAX_LANGUAGES = 1_000
#: Distinct (language, n-gram) counts that a task holds before it hands them on.
FLUSH = 400_000
SALTS = 32
_MARK = 1  # the pad; code points are stored plus 1, so 0 means "no character"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def held_out(doc_id: str = "doc_id"):
    fold = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(fold == 0, F.lit(True))


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram codes, their text, whether a text has a letter), texts in order."""
    lowered = [(x or "").lower() for x in column.to_pylist()]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(x) for x in lowered], np.int64)
    owner = np.repeat(np.arange(len(lowered), dtype=np.int32), sizes)
    letter = _letters()[points]
    prior = np.zeros(len(points), bool)
    prior[1:] = letter[:-1] & (owner[1:] == owner[:-1])
    # Each word is laid out as: mark, letters, mark.
    first = np.flatnonzero(letter & ~prior)
    at = np.flatnonzero(letter)
    word = np.cumsum((letter & ~prior)[at]) - 1
    seq = np.full(len(at) + 2 * len(first), _MARK, np.int64)
    place = np.arange(len(at)) + 2 * word + 1
    seq[place] = points[at].astype(np.int64) + 1
    of = np.zeros(len(seq), np.int32)
    of[place] = owner[at]
    a, b, c = place - 1, place, place + 1
    last = seq[c] == _MARK
    one = seq[b]
    two = seq[a] | (one << 21)
    tail = one[last] | (seq[c[last]] << 21)  # the pair of the last letter and the closing mark
    three = two | (seq[c] << 42)
    owners = of[b]
    codes = np.concatenate([one, two, tail, three])
    owned = np.concatenate([owners, owners, owners[last], owners])
    order = np.argsort(owned, kind="stable")
    has = np.zeros(len(lowered), bool)
    has[owners] = True
    return codes[order], owned[order], has


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first; ties by code."""
    found, count = np.unique(codes, return_counts=True)
    if len(found) > size:
        # Only codes at or above the count of the last place can be among the first ``size``.
        least = np.partition(count, len(count) - size)[len(count) - size]
        keep = count >= least
        found, count = found[keep], count[keep]
    return found[np.lexsort((found, -count))][:size]


@dataclass(frozen=True)
class Profiles:
    names: list[str]
    codes: np.ndarray  # sorted n-grams of all profiles
    ranks: np.ndarray  # per language and code; the last column stands for unknown n-grams
    size: int

    def best(self, own: np.ndarray) -> tuple[str, float]:
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        at = np.where(self.codes[at] == own, at, len(self.codes))
        ranks = self.ranks[:, at]
        away = np.abs(ranks - np.arange(len(own)))
        away[ranks < 0] = self.size
        total = away.sum(axis=1)
        k = int(total.argmin())
        return self.names[k], float(1.0 - total[k] / (len(own) * self.size))


def learn(docs: DataFrame, size: int = SIZE) -> Profiles | None:
    """Profiles from all rows that are not held out and have a language."""

    def count(batches):
        names: dict[str, int] = {}
        parts: list[tuple[int, np.ndarray, np.ndarray]] = []
        held = 0

        def merged(close: bool):
            nonlocal parts, held
            by_name: dict[int, list] = {}
            for k, codes, counts in parts:
                by_name.setdefault(k, []).append((codes, counts))
            parts, held = [], 0
            for k, found in by_name.items():
                codes, back = np.unique(np.concatenate([x[0] for x in found]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([x[1] for x in found])).astype(np.int64)
                parts.append((k, codes, counts))
                held += len(codes)
            if close or held > FLUSH // 2:
                label = list(names)
                for k, codes, counts in parts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label[k]] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                        names=["lang", "gram", "n"],
                    )
                parts, held = [], 0

        for batch in texts.slices(batches):
            codes, owned, _ = grams(batch.column("text"))
            kind = np.array(
                [names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int32
            )
            for k in np.unique(kind):
                own, n = np.unique(codes[kind[owned] == k], return_counts=True)
                parts.append((int(k), own, n))
                held += len(own)
            if held > FLUSH:
                yield from merged(False)
        yield from merged(True)

    counts = (
        docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", "text")
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    # The first places of a language are among the first places of its salted parts.
    order = [F.desc("n"), F.asc("gram")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    top = (
        counts.withColumn("_place", F.row_number().over(part))
        .where(F.col("_place") <= size)
        .withColumn("place", F.row_number().over(whole) - 1)
        .where(F.col("place") < size)
        .select("lang", "gram", "place")
    )
    # size rows per language and at most MAX_LANGUAGES languages: a proven bound.
    rows = top.limit(size * MAX_LANGUAGES + 1).toArrow()
    if rows.num_rows > size * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not rows.num_rows:
        return None
    names = sorted(set(rows.column("lang").to_pylist()))
    gram, place = rows.column("gram").to_numpy(), rows.column("place").to_numpy()
    codes = np.unique(gram)
    ranks = np.full((len(names), len(codes) + 1), -1, np.int32)
    index = {name: i for i, name in enumerate(names)}
    own = np.array([index[x] for x in rows.column("lang").to_pylist()])
    ranks[own, np.searchsorted(codes, gram)] = place
    return Profiles(names, codes, ranks, size)


def predict(docs: DataFrame, profiles: Profiles | None) -> DataFrame:
    """Language and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        known = shared.value
        for batch in texts.slices(batches):
            names, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            if known is not None:
                codes, owned, has = grams(batch.column("text"))
                bounds = np.searchsorted(owned, np.arange(batch.num_rows + 1))
                for i in np.flatnonzero(has):
                    own = ranked(codes[bounds[i] : bounds[i + 1]], known.size)
                    names[i], scores[i] = known.best(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text"
    ).mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, size: int = SIZE) -> DataFrame:
    return predict(docs, learn(docs, size))
