"""Quality rules: hard counts plus a calibrated logistic regression over hashed n-grams.

``train`` fits one model on labelled rows; ``score`` applies it to every whole text in Arrow
batches. Features are hashed words and hashed character 2-, 3- and 4-grams, each as a share of
its kind in the text, so that long and short texts are on one scale. The regression is fitted on
four fifths of the labelled rows and calibrated (Platt scaling) on the other fifth.

The fit uses at most ``max_rows`` labelled rows, the first in order of a hash of doc_id, with their
whole texts: a documented bound of the training set. A text has at most four times 2**BITS
features, whatever its length. Scoring has no bound.

Defined results
- null or empty text: no words, so all counts are 0 and ``base_failed`` is true.
- no usable labelled rows, or one class only: the verdict is the base rule alone, score null.
- a null doc_id is kept as null; repeated rows give repeated results; extra columns are ignored.
- labels with a null doc_id or quality are skipped; a doc_id with two labels counts twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricestrata.llm import texts

BITS = 14
DIM = 1 << BITS
KINDS = ("word", 2, 3, 4)
MAX_ROWS = 6_000
MAX_PARTS = 12
ROWS_PER_PART = 400
THRESHOLD = 0.5
MIN_WORDS = 20
REPEAT_WINDOW = 8
_U = np.uint64

#: The characters that count as symbols (fixed values).
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True

OUT = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, score double"
)


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature, then the two numbers of the calibration."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (margin + self.bias) + self.shift, -60, 60)
        return 1.0 / (1.0 + np.exp(-z))


def _features(data, offsets, words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per kind: (hash bucket of each item, item bounds per text)."""
    starts, ends, before, sums = words
    n = len(data)
    for k, kind in enumerate(KINDS):
        if kind == "word":
            codes, bounds = texts.ranged(sums, starts, ends), before
        else:
            size = max(n - kind + 1, 0)
            codes = np.zeros(size, np.uint64)
            for i in range(kind):
                codes |= data[i : i + size].astype(np.uint64) << _U(8 * i)
            codes += _U(1)
            # A gram that would cross into the next text belongs to none: it is cut off below.
            bounds = offsets
        bucket = (texts.mix(codes + _U(k << 60)) >> _U(64 - BITS)).astype(np.int32)
        yield bucket, bounds, (0 if kind == "word" else kind - 1)


def _ranges(bounds: np.ndarray, short: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    lo = np.minimum(bounds[:-1], size)
    return lo, np.clip(bounds[1:] - short, lo, size)


def margins(model: Model, data, offsets, words) -> np.ndarray:
    total = np.zeros(len(offsets) - 1)
    for k, (bucket, bounds, short) in enumerate(_features(data, offsets, words)):
        w = model.weights[k * DIM : (k + 1) * DIM]
        run = np.zeros(len(bucket) + 1)
        np.cumsum(w[bucket], out=run[1:])
        lo, hi = _ranges(bounds, short, len(bucket))
        total += (run[hi] - run[lo]) / np.maximum(hi - lo, 1)
    return total


def vectors(data, offsets, words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse (index, share) per text, for training."""
    parts: list[list] = [[] for _ in range(len(offsets) - 1)]
    for k, (bucket, bounds, short) in enumerate(_features(data, offsets, words)):
        for i, (a, b) in enumerate(zip(*_ranges(bounds, short, len(bucket)), strict=True)):
            index, count = np.unique(bucket[a:b], return_counts=True)
            parts[i].append((index + k * DIM, count / max(b - a, 1)))
    return [
        (np.concatenate([p[0] for p in ps]), np.concatenate([p[1] for p in ps])) for ps in parts
    ]


def split_words(data: np.ndarray, offsets: np.ndarray):
    starts, ends, before = texts.spans(~texts.SPACE[data], offsets)
    return starts, ends, before, texts.prefix(data)


def _repeat_words(words: list[bytes], width: int) -> int:
    """Words inside windows that occur twice or more; exact, on the words themselves."""
    seen: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for i in range(len(words) - width + 1):
        window = tuple(words[i : i + width])
        first = seen.setdefault(window, i)
        if first != i:
            hit[i : i + width] = b"\1" * width
            hit[first : first + width] = b"\1" * width
    return sum(hit)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def base_counts(data: np.ndarray, offsets: np.ndarray, words) -> dict[str, np.ndarray]:
    starts, ends, before, sums = words
    n_texts = len(offsets) - 1
    lead = (data & 0xC0) != 0x80
    n_words = np.diff(before)
    out = {
        "n_words": n_words,
        "word_chars": texts.sums_by_text(lead & ~texts.SPACE[data], offsets),
        "n_symbols": texts.sums_by_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.zeros(n_texts, np.int64),
        "n_repeat_words": np.zeros(n_texts, np.int64),
    }
    code = texts.mix(texts.ranged(sums, starts, ends))
    window = np.zeros(max(len(code) - REPEAT_WINDOW + 1, 0), np.uint64)
    for i in range(REPEAT_WINDOW):
        window *= _U(0x9E3779B97F4A7C15)
        window += code[i : i + len(window)]
    breaks = texts.sums_by_text(data == 10, offsets)
    for i in range(n_texts):
        a, b = before[i], before[i + 1]
        own = window[a : max(b - REPEAT_WINDOW + 1, a)]
        raw = None
        # Equal windows have equal hashes, so only texts with equal hashes need the exact count.
        if len(own) > 1:
            order = np.sort(own)
            if (order[1:] == order[:-1]).any():
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                out["n_repeat_words"][i] = _repeat_words(raw.split(), REPEAT_WINDOW)
        if breaks[i]:
            raw = raw or data[offsets[i] : offsets[i + 1]].tobytes()
            out["n_dup_lines"][i] = _dup_lines(raw)
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > 30 * n_words)
    return out


def train(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, rounds: int = 4
) -> Model | None:
    """Fit on a bounded set of labelled rows; None if both classes are not there.

    The rows stay in Spark: in each round every part of them takes gradient steps from the
    common weights, and what the parts return is averaged (parameter mixing). The driver holds one
    weight vector, never rows or features.
    """
    chosen = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "quality")
        .limit(max_rows)
    )
    # At most max_rows rows of two numbers: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 4
    rows = rows.select(F.col("quality").cast("int").alias("quality"), held.alias("held"), "text")
    rows = texts.stored(rows, "quality-train")
    classes = {
        (r["quality"], r["held"]): r["count"] for r in rows.groupBy("quality", "held").count().collect()
    }
    if not all(any(q == k for q, _ in classes) for k in (0, 1)):
        return None
    if not all((q, h) in classes for q in (0, 1) for h in (True, False)):
        fit, check = rows, rows  # too few rows to hold some out
    else:
        fit, check = rows.where("not held"), rows.where("held")
    n = {q: max(sum(c for (k, _), c in classes.items() if k == q), 1) for q in (0, 1)}
    parts = max(1, min(MAX_PARTS, sum(n.values()) // ROWS_PER_PART))
    fit = fit.select("quality", "text").repartition(parts, F.xxhash64("text"))
    context = docs.sparkSession.sparkContext
    weights, bias = np.zeros(len(KINDS) * DIM, np.float32), 0.0
    for _ in range(rounds):
        shared = context.broadcast((weights, bias))

        def step(batches, shared=shared):
            y, index, value = [], [], []
            for batch in texts.slices(batches):
                data, offsets = texts.utf8(batch.column("text"))
                y.extend(batch.column("quality").to_pylist())
                for i, v in vectors(data, offsets, split_words(data, offsets)):
                    index.append(i.astype(np.int32))
                    value.append(v.astype(np.float32))
            if not y:
                return
            w, b = _fit(
                np.concatenate(index), np.concatenate(value),
                np.repeat(np.arange(len(y), dtype=np.int32), [len(x) for x in index]),
                np.array(y, np.float64), n, *shared.value,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(y)], pa.int64()), pa.array([w.tobytes()], pa.binary()),
                 pa.array([b], pa.float64())],
                names=["n", "w", "b"],
            )

        made = fit.mapInArrow(step, "n bigint, w binary, b double")
        # One vector per part meets in one task, one vector reaches the driver.
        mean = made.repartition(1).sortWithinPartitions("n", "b").mapInArrow(_mean, "w binary, b double")
        found = mean.first()
        weights, bias = np.frombuffer(found["w"], np.float32), found["b"]
    model = Model(weights, bias, 1.0, 0.0)
    found = _margins(check, model).toArrow()  # at most max_rows pairs of numbers
    margin, label = found.column("margin").to_numpy(), found.column("quality").to_numpy()
    slope, shift = _platt(margin, label)
    return Model(weights, bias, slope, shift)


def _mean(batches) -> Iterator[pa.RecordBatch]:
    """The mean of weight vectors, each counted by its rows."""
    rows, total, bias = 0, np.zeros(len(KINDS) * DIM), 0.0
    for batch in batches:
        for n, w, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            rows, bias = rows + n, bias + n * b
            total += n * np.frombuffer(w, np.float32)
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([(total / rows).astype(np.float32).tobytes()], pa.binary()),
             pa.array([bias / rows], pa.float64())],
            names=["w", "b"],
        )


def _margins(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in texts.slices(batches):
            data, offsets = texts.utf8(batch.column("text"))
            z = margins(shared.value, data, offsets, split_words(data, offsets)) + shared.value.bias
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality"), pa.array(z)], names=["quality", "margin"]
            )

    return rows.select("quality", "text").mapInArrow(run, "quality int, margin double")


def _fit(flat, vals, row, y, classes, weights, bias, steps: int = 40, l2: float = 1e-7):
    """Logistic regression by Adagrad steps on the gradient of one part, classes weighted equally."""
    weights = weights.copy()
    weight = np.where(y == 1, 0.5 / classes[1], 0.5 / classes[0]) * (sum(classes.values()) / len(y))
    seen, seen_bias = np.full(len(weights), 1e-12), 1e-12
    for _ in range(steps):
        z = np.bincount(row, vals * weights[flat], len(y)) + bias
        error = (1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))) - y) * weight
        grad = np.bincount(flat, vals * error.astype(np.float32)[row], len(weights)) + l2 * weights
        seen += grad * grad
        weights -= (2.0 * grad / np.sqrt(seen)).astype(np.float32)
        seen_bias += error.sum() ** 2
        bias -= 0.2 * error.sum() / np.sqrt(seen_bias)
    return weights, float(bias)


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """P(1) = sigmoid(slope * margin + shift) with smoothed targets, by damped Newton steps.

    The margins are brought to mean 0 and deviation 1 first, and a step is halved until the
    loss falls, so margins of any size and separable classes do not upset it.
    """
    pos, neg = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    mean, width = float(margin.mean()), float(margin.std()) or 1.0
    x = np.stack([(margin - mean) / width, np.ones(len(margin))])

    def loss(c: np.ndarray) -> float:
        z = c @ x
        return float((np.logaddexp(0, z) - target * z).sum() + 1e-6 * c @ c)

    at = np.array([0.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(at @ x, -60, 60)))
        g = x @ (p - target) + 2e-6 * at
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 2e-6 * np.eye(2), g)
        now, part = loss(at), 1.0
        while part > 1e-8 and loss(at - part * step) > now - 1e-4 * part * (g @ step):
            part /= 2
        if part <= 1e-8:
            break
        at = at - part * step
    return float(at[0] / width), float(at[1] - at[0] * mean / width)


def _judged(fitted: Model | None, column: pa.Array, threshold: float):
    """(counts, verdicts, probabilities) of one slice of texts."""
    data, offsets = texts.utf8(column)
    words = split_words(data, offsets)
    out = base_counts(data, offsets, words)
    if fitted is None:
        return out, ~out["base_failed"], pa.nulls(len(column), pa.float64())
    p = fitted.probability(margins(fitted, data, offsets, words))
    return out, ~out["base_failed"] & (p >= threshold), pa.array(p)


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, calibrated probability of good quality and verdict of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in texts.slices(batches):
            out, good, prob = _judged(shared.value, batch.column("text"), threshold)
            columns = [batch.column("doc_id"), *(pa.array(x) for x in out.values())]
            columns += [pa.array(good), prob]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *out, "kept", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, OUT)


def kept(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for batch in texts.slices(batches):
            _, good, _ = _judged(shared.value, batch.column(at), threshold)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))
