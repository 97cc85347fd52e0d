"""Numpy views of Arrow text columns: byte buffers, word bounds, and hashes of any byte range.

Everything here works on one slice of a batch; ``slices`` bounds a slice by bytes, so that the
working arrays of a task do not grow with the batch. A single text longer than the bound is a
slice of its own.
"""

from __future__ import annotations

import gc
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Small enough for a slice's arrays to stay in the cache of a core.
SLICE_BYTES = 1 << 17
#: For the tokenizers, whose tables gain from more words at a time.
CODED_BYTES = 1 << 19

#: ASCII white space: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_U = np.uint64


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, extended on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(n + 1, SLICE_BYTES + 1, 2 * len(self.up))
            for name, base in (("up", _PRIME), ("down", _INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values, so that every output bit depends on every input bit."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(29)
    x = x * _U(0xC2B2AE3D27D4EB4F)
    x ^= x >> _U(32)
    return x


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial byte hash; ``ranged`` reads the hash of any range from them."""
    up, _ = _POWERS.get(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = data.astype(np.uint64)
    terms += _U(1)
    terms *= up[: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def ranged(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] that does not depend on where the range lies."""
    _, down = _POWERS.get(len(sums))
    return (sums[end] - sums[start]) * down[start]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


#: The tokenizers, with their tables, that a Python worker keeps between tasks.
TABLES: list[dict] = []


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of text, one row at least.

    A worker that turns to another operator gives up its tokenizers here.
    """
    if limit != CODED_BYTES and any(TABLES):
        for held in TABLES:
            held.clear()
        gc.collect()
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def _latin(kind: str) -> str:
    """Characters below 256 of a Unicode class, as the inside of a character class."""
    test = {
        "L": lambda c: unicodedata.category(c)[0] == "L",
        "N": lambda c: unicodedata.category(c)[0] == "N",
        "s": lambda c: c.isspace() and not "\x1c" <= c <= "\x1f",
    }[kind]
    return "".join(re.escape(c) for c in map(chr, range(256)) if test(c))


class Splitter:
    """``findall`` of a pattern over Unicode classes.

    A text whose characters all lie below 256 is split by the same pattern with the classes
    written out, which the standard library matches about twice as fast; others by ``regex``.
    """

    def __init__(self, pattern: str) -> None:
        letters, numbers, space = _latin("L"), _latin("N"), _latin("s")
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
        for name, inside in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", space)):
            plain = plain.replace(f"[{name}]", f"[{inside}]").replace(name, f"[{inside}]")
        self.plain = re.compile(plain.replace(r"\S", f"[^{space}]")).findall
        self.full = regex.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.full(text)
        return self.plain(text)


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross texts: (starts, ends, runs before each text)."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(len(offsets), np.int64),)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= cut[1:n] | ~inside[:-1]
    last = inside.copy()
    last[:-1] &= cut[1:n] | ~inside[1:]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def sums_by_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between each two offsets."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


#: Rows that a file may hold (as a power of two) for its numbers to fit beside the file's.
_ROW_BITS = 36


def with_row_id(df: DataFrame, name: str = "_rid") -> DataFrame:
    """A number per row, the same in every job over the same stored table.

    It is made of the file's place in the list of files and the row's place in its file, so it depends
    neither on how Spark cuts the scan nor on the cores it has at the time. ``df`` must be a scan of stored
    Parquet files with row-wise steps on top, as all operators that use it state. The list of files, which the
    driver holds for the scan anyway, is broadcast.
    """
    spark, file, number = df.sparkSession, free_name(df, "_file"), free_name(df, "_number")
    # Spark writes local paths in two ways.
    names = sorted({re.sub("^file:/+", "file:/", path) for path in df.inputFiles()})
    files = spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), f"{file} string, {number} bigint")
    at = df.metadataColumn("_metadata")
    path = F.regexp_replace(at["file_path"], "^file:/+", "file:/")
    rows = df.withColumns({file: path, name: at["row_index"]}).join(F.broadcast(files), file, "left")
    known = F.when(F.col(number).isNotNull() & (F.col(name) < 1 << _ROW_BITS), F.shiftleft(number, _ROW_BITS) + F.col(name))
    known = known.otherwise(F.raise_error(F.lit("a row of an unlisted or too long file")).cast("bigint"))
    return rows.select(*(F.col(f"`{c}`") for c in df.columns), known.alias(name))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Arrow batches of at most ``rows`` rows in this session, unless it asks for fewer.

    Batches are counted in rows, so with long texts the default of 10,000 makes a task hold
    tens of megabytes several times over.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


_LOCAL: list[str] = []


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="llm-"))
        root = _LOCAL[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
