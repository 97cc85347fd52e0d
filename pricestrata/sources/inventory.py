"""What a folder of evidence holds: an inventory without contents, and digests of chosen files."""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricestrata.session import dealt, path_exists, settle

DIGESTS = "relative_path string, body_hash string, size bigint, error string"
ENTRIES = "relative_path string, length bigint"
_CHUNK = 1 << 20
#: Names that a listing hands back at once.
_NAMES = 10_000
#: Bytes of files that are held before they are handed back.
_HELD = 16 << 20


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if re.match(r"[a-z0-9]+:", folder) else f"file://{folder}")


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """(relative_path, length) of all files below a folder; tasks list its folders, level by level, open no file
    and leave out empty and hidden ones, as Spark's file sources do."""
    found = spark.createDataFrame([], ENTRIES)
    if path_exists(spark, folder):
        level = spark.createDataFrame([("",)], "relative_path string")
        while not level.isEmpty():
            # Written once: a level is read for its files and for the folders of the next one.
            listed = settle(dealt(level).mapInArrow(_lister(folder), ENTRIES), "listing")
            found = found.unionByName(listed.where("length > 0"))
            level = listed.where("length IS NULL").select("relative_path")
    return found


def contents(paths: DataFrame, folder: str) -> DataFrame:
    """(relative_path, content) of the files that ``paths`` (relative_path) names, opened by the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            names: list[str] = []
            found: list[bytes] = []
            held = 0
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{root}/{name}") as f:
                    found.append(f.read())
                names.append(name)
                held += len(found[-1])
                if held >= _HELD:
                    yield _contents(names, found)
                    names, found, held = [], [], 0
            if names:
                yield _contents(names, found)

    def _contents(names: list[str], found: list[bytes]) -> pa.RecordBatch:
        arrays = [pa.array(names, pa.string()), pa.array(found, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["relative_path", "content"])

    # Short rows that stand for whole files: a small table of them is one part.
    return dealt(paths.select("relative_path")).mapInArrow(run, "relative_path string, content binary")


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(store, path: str) -> Iterator[tuple[str, int | None]]:
    """Names in a folder with their lengths, null for folders; a local folder is read as a stream."""
    from pyarrow import fs

    if store.type_name == "local":
        with os.scandir(path) as entries:
            for entry in entries:
                yield entry.name, None if entry.is_dir() else entry.stat().st_size
    else:
        for info in store.get_file_info(fs.FileSelector(path)):
            yield info.base_name, None if info.type == fs.FileType.Directory else info.size


def _lister(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for above in batch.column(0).to_pylist():
                names = (x for x in _entries(store, f"{root}/{above}") if not _hidden(x[0]))
                while part := list(islice(names, _NAMES)):
                    paths = [f"{above}/{name}" if above else name for name, _ in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths, pa.string()), pa.array([length for _, length in part], pa.int64())],
                        names=["relative_path", "length"],
                    )

    return run


def _digest(lines) -> tuple[str | None, int | None, str | None]:
    """Hash and length of a gzip body, a chunk at a time; a body may have several members."""
    found, size, unzip = hashlib.sha256(), 0, zlib.decompressobj(31)
    read = 0
    try:
        while packed := lines.read(_CHUNK):
            read += len(packed)
            while packed:
                if unzip.eof:
                    unzip = zlib.decompressobj(31)
                body = unzip.decompress(packed, _CHUNK)
                found.update(body)
                size += len(body)
                packed = unzip.unconsumed_tail or unzip.unused_data
        while body := unzip.decompress(b"", _CHUNK):
            found.update(body)
            size += len(body)
    except zlib.error:
        return None, None, "BODY_UNREADABLE"
    if not read:
        return None, None, "FILE_EMPTY"
    if not unzip.eof:
        return None, None, "BODY_UNREADABLE"
    return found.hexdigest(), size, None


def digests(paths: DataFrame, folder: str) -> DataFrame:
    """Body hash and size of the files that ``paths`` (relative_path) names, and of no others.

    A file is read in chunks, so its size does not matter; one that is not there or torn gives its error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                try:
                    with store.open_input_stream(f"{root}/{name}", compression=None) as lines:
                        rows.append((name, *_digest(lines)))
                except FileNotFoundError:
                    rows.append((name, None, None, "FILE_MISSING"))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("relative_path", "body_hash", "size", "error"), r, strict=True)) for r in rows],
                schema=pa.schema([
                    ("relative_path", pa.string()), ("body_hash", pa.string()), ("size", pa.int64()), ("error", pa.string()),
                ]),
            )

    # Short rows that stand for whole files: a small table of them is one part.
    return dealt(paths.select("relative_path").where(F.col("relative_path").isNotNull())).mapInArrow(run, DIGESTS)
