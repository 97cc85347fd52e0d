"""Token ids in flat binary files.

Format: a part holds the ids of its documents one after the other as unsigned little-endian
16-bit integers (32-bit where the vocabulary needs it) in ``part-N.ids``, and in ``part-N.idx``
one record per document: the 64-bit offset of its first id in the part, the 64-bit doc_id and a 64-bit flag that is
1 for a null doc_id; a last record holds the end offset. Both are read by memory map. Documents stand
in ascending doc_id order over all parts (ties by text); the base of a part is the prefix
sum of the id counts of the parts before it.

Writing ranges the documents over tasks by doc_id, each task writes its part under a name of its
own attempt and renames it, so that a task that runs again leaves the same file. Only a manifest
of one row per part goes on; its prefix sums are a window over these few rows.

Words recur, so the distinct pieces of a slice are encoded once, by the tokenizers library, and
kept in a table of bounded size per worker; a text with a special token written out goes to the library whole.

Defined results
- null or empty text: the end id alone. null doc_id: written first, read back as null.
- repeated rows are written as often as they occur; no rows: no parts, an empty result.
- extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricestrata.llm import texts

END_ID = 0
TABLE_PIECES = 1_200_000
#: Pieces that go to the library as one text.
JOINED = 2_000
#: How the byte-level pre-tokenizer splits a text (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MANIFEST = "part int, n_docs bigint, n_tokens bigint"


class Encoder:
    """Texts to ids as raw little-endian bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = max(self.tokenizer.get_vocab().values()) + 1
        self.type = np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = texts.Splitter(PATTERN)
        self.table: dict[str, bytes] = {}
        # Bytes of each token: its letters, as each stands for one byte.
        self.width = np.zeros(vocabulary, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)

    def raw(self, ids: Iterable[int]) -> bytes:
        return np.asarray(ids, self.type).tobytes()

    def _whole(self, rows: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)
        return [self.raw(x.ids) for x in found]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces. Those of a space and something else are sent joined: the library cuts
        them apart at the same places, which the byte widths of the tokens confirm."""
        out = dict.fromkeys(pieces, b"")
        alike = [p for p in pieces if p[0] == " " and len(p) > 1 and not p[1].isspace()]
        for at in range(0, len(alike), JOINED):
            some = alike[at : at + JOINED]
            ids = np.array(
                self.tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)[0].ids
            )
            ends = np.cumsum(self.width[ids])
            want = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in some])
            to = np.searchsorted(ends, want)
            if to[-1] != len(ids) - 1 or (ends[to] != want).any():
                out.update(zip(some, self._whole(some), strict=True))
                continue
            raw, n = self.raw(ids), self.type.itemsize
            cuts = [0, *((to + 1) * n).tolist()]
            out.update(zip(some, [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
        rest = [p for p in pieces if not out[p]]
        out.update(zip(rest, self._whole(rest), strict=True))
        return [out[p] for p in pieces]

    def encode(self, rows: list[str]) -> list[bytes]:
        plain = [not any(s in x for s in self.special) for x in rows]
        pieces = [self.split(x) if ok else [] for x, ok in zip(rows, plain, strict=True)]
        found = [list(map(self.table.get, p)) for p in pieces]
        fresh: set[str] = set()
        for p, f in zip(pieces, found, strict=True):
            if None in f:
                fresh.update(x for x, y in zip(p, f, strict=True) if y is None)
        if len(self.table) + len(fresh) > TABLE_PIECES:
            self.table.clear()
            fresh = {x for p in pieces for x in p}
        missing = list(fresh)
        self.table.update(zip(missing, self._pieces(missing), strict=True))
        known = self.table.__getitem__
        return [
            (b"".join(map(known, p)) if None in f else b"".join(f)) if ok else self._whole([x])[0]
            for x, ok, p, f in zip(rows, plain, pieces, found, strict=True)
        ]


_ENCODERS: dict[str, Encoder] = {}
texts.TABLES.append(_ENCODERS)


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _filesystem(root: str):
    """The file system of a shared folder, for tasks: local, HDFS or an object store."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def _replace(files, source: str, target: str) -> None:
    """Rename over a file that an earlier attempt may have left; both hold the same bytes."""
    from pyarrow import fs

    if not isinstance(files, fs.LocalFileSystem):
        if files.get_file_info(target).type != fs.FileType.NotFound:
            files.delete_file(target)
    files.move(source, target)


def write(docs: DataFrame, root: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents below ``root``; the stored manifest, one row per part."""

    def run(batches):
        own = encoder(path)
        files, base = _filesystem(root)
        context = TaskContext.get()
        part = context.partitionId()
        name, mine = f"{base}/part-{part:06d}", f"{base}/_try-{part:06d}-{context.taskAttemptId()}"
        end, at = own.raw([end_id]), 0
        index: list[np.ndarray] = []
        out = None
        for batch in texts.slices(batches, limit=texts.CODED_BYTES):
            if out is None:
                files.create_dir(base, recursive=True)
                out = files.open_output_stream(mine + ".ids")
            made = own.encode([x or "" for x in batch.column("text").to_pylist()])
            sizes = np.array([len(x) // own.type.itemsize + 1 for x in made], np.int64)
            ids = batch.column("doc_id")
            record = np.zeros((len(made), 3), "<i8")
            record[:, 0] = at + np.cumsum(sizes) - sizes
            record[:, 1] = ids.fill_null(0).to_numpy(zero_copy_only=False)
            record[:, 2] = ids.is_null().to_numpy(zero_copy_only=False)
            index.append(record)
            at += int(sizes.sum())
            for x in made:
                out.write(x)
                out.write(end)
        if out is None:
            return
        out.close()
        index.append(np.array([[at, 0, 0]], "<i8"))
        with files.open_output_stream(mine + ".idx") as f:
            f.write(np.concatenate(index).tobytes())
        for kind in (".ids", ".idx"):
            _replace(files, mine + kind, name + kind)
        n_docs = sum(map(len, index)) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([n_docs], pa.int64()), pa.array([at], pa.int64())],
            names=["part", "n_docs", "n_tokens"],
        )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Copies of one doc_id are split by a digest of the text; equal rows may stand in any order.
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.asc_nulls_first("text")]
    placed = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return texts.stored(placed.mapInArrow(run, MANIFEST), "token-manifest")


def based(manifest: DataFrame) -> DataFrame:
    """The manifest with each part's base: the prefix sum of ids before it.

    The parts are as many as the write tasks, so this window holds no more rows than that.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _mapped(files, name: str, kind: np.dtype) -> np.ndarray:
    """The numbers of a file: by memory map where it is a local path, else read."""
    from pyarrow import fs

    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(name, kind, "r") if os.path.getsize(name) else np.zeros(0, kind)
    with files.open_input_file(name) as f:
        return np.frombuffer(f.read(), kind)


def read(spark: SparkSession, root: str, manifest: DataFrame, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the checksum of its ids."""
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def run(batches):
        kind = encoder(path).type
        files, folder = _filesystem(root)
        for batch in batches:
            for part, base in zip(
                batch.column("part").to_pylist(), batch.column("base").to_pylist(), strict=True
            ):
                name = f"{folder}/part-{part:06d}"
                index = _mapped(files, name + ".idx", np.dtype("<i8")).reshape(-1, 3)
                ids = _mapped(files, name + ".ids", kind)
                for at in range(0, len(index) - 1, 10_000):
                    own = np.array(index[at : at + 10_001])
                    crc = [
                        zlib.crc32(ids[a:b].astype("<u4").tobytes())
                        for a, b in zip(own[:-1, 0], own[1:, 0], strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own[:-1, 1], pa.int64(), mask=own[:-1, 2] == 1),
                            pa.array(own[:-1, 0] + base), pa.array(np.diff(own[:, 0])),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # The few rows of the manifest are spread by ranges of a given number, which AQE leaves alone,
    # so that every part is read by a task of its own.
    parts = based(manifest).select("part", "base").repartitionByRange(max(1, manifest.count()), "part")
    return parts.mapInArrow(run, schema)
