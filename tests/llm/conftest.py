from __future__ import annotations

import uuid

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; a caller's table may have them too.
CLASHES = ("_rid", "rid", "at", "u", "component", "n_words", "kept", "score", "number", "size", "side", "part")


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a stored table, as the operators want it."""

    def make(rows, schema=DOCS):
        path = str(tmp_path / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return make


@pytest.fixture
def docs(stored):
    """Documents from (doc_id, text) pairs or from texts alone."""

    def make(items, lang="en"):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(items)]
        return stored([(i, t, lang, "s", len(t or "")) for i, t in pairs])

    return make


LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (None, "a text without an id, of some words"),
    (5, "same same same"), (5, "same same same"), (6, LONG), (7, "Grüße, naïve 日本 👍 text"), (8, "!!! ???"),
]


@pytest.fixture
def odd(stored):
    """Nulls, empty and long texts, repeated rows, and extra columns with clashing names."""
    from pyspark.sql import functions as F

    base = stored([(i, t, None, None, None) for i, t in ODD])
    return stored(
        [tuple(r) + tuple("x" for _ in CLASHES) for r in base.collect()],
        DOCS + ", " + ", ".join(f"{c} string" for c in CLASHES),
    )


@pytest.fixture
def none(stored):
    return stored([])
