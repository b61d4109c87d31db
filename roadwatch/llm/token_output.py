"""Token ids as binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents in blocks of :data:`BLOCK` ids:
each block stores its minimum, the differences packed at the bit width of
their :data:`PERCENTILE`, and an exception list (position, high bits) for the
wider ones. Block starts and the document directory are indexed at the end.

    "PFR1"  block* (min u32, width u8, exceptions u32, count u32, packed bits,
    positions u16*, high bits u32*)  block starts u64*  ends of documents u64*
    document ids i64*  which ids are NULL u8*  (blocks, documents, ids, index
    start) u64*4  "PFR1"

Files are written by the tasks of one range-partitioned job, through the
filesystem that the shared folder's address names. Each attempt writes a name
of its own and only the manifest, a checkpointed table of what the successful
tasks wrote, makes a file part of the output: lost executors and repeated
attempts leave at most unreferenced files.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadwatch.llm import tokens
from roadwatch.llm.common import cut, scratch

MAGIC = b"PFR1"
BLOCK = 4096
#: Share of a block's values that fit the packed width.
PERCENTILE = 90
END_ID = 2
#: Bytes of text encoded at once: a slice's distinct words are looked up once each.
SLICE = 8 << 20
HEAD, TAIL = "<IBII", "<QQQQ"


def pack(ids: np.ndarray) -> bytes:
    low = int(ids.min())
    v = (ids - np.uint32(low)).astype(np.uint32)
    at = min(len(v) - 1, len(v) * PERCENTILE // 100)
    width = int(np.partition(v, at)[at]).bit_length()
    bits = np.unpackbits(v.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width:]
    wide = np.flatnonzero(v >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    return b"".join([struct.pack(HEAD, low, width, len(wide), len(v)), np.packbits(bits).tobytes(),
                     wide.astype("<u2").tobytes(), (v[wide] >> np.uint32(min(width, 31))).astype("<u4").tobytes()])


def unpack(data: bytes, at: int = 0) -> np.ndarray:
    low, width, wide, n = struct.unpack_from(HEAD, data, at)
    at += struct.calcsize(HEAD)
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, 32 - width:] = bits
    v = np.packbits(full, axis=1).view(">u4").ravel().astype(np.uint32)
    at += size
    if wide:
        where = np.frombuffer(data, "<u2", wide, at)
        v[where] |= np.frombuffer(data, "<u4", wide, at + 2 * wide).astype(np.uint32) << np.uint32(width)
    return v + np.uint32(low)


class Writer:
    def __init__(self, out):
        self.out, self.at = out, 0
        self.starts, self.ends, self.docs = [], [], []
        self.held: list[np.ndarray] = []
        self.n_held = self.n = 0
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.n += len(ids)
        self.ends.append(self.n)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= 64 * BLOCK:
            self._flush(BLOCK)

    def _flush(self, least: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        i = 0
        while len(ids) - i >= least:
            self.starts.append(self.at)
            self._put(pack(ids[i:i + BLOCK]))
            i += BLOCK
        self.held, self.n_held = [ids[i:]], max(0, len(ids) - i)

    def close(self) -> None:
        self._flush(1)
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes() + np.array(self.ends, "<u8").tobytes())
        self._put(np.array([d or 0 for d in self.docs], "<i8").tobytes() + np.array([d is None for d in self.docs], np.uint8).tobytes())
        self._put(struct.pack(TAIL, len(self.starts), len(self.docs), self.n, index) + MAGIC)


class Reader:
    """Random access to a file: ``ids(start, stop)`` reads only the blocks it needs."""

    def __init__(self, f, size: int):
        self.f = f
        f.seek(size - struct.calcsize(TAIL) - 4)
        tail = f.read(struct.calcsize(TAIL) + 4)
        blocks, docs, self.n, index = struct.unpack(TAIL, tail[:-4])
        f.seek(0)
        if tail[-4:] != MAGIC or f.read(4) != MAGIC:
            raise ValueError("not a token file")
        f.seek(index)
        data = f.read(8 * blocks + 17 * docs)
        self.starts = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(index)).astype(np.int64)
        self.ends = np.frombuffer(data, "<u8", docs, 8 * blocks).astype(np.int64)
        ids, null = np.frombuffer(data, "<i8", docs, 8 * (blocks + docs)), np.frombuffer(data, np.uint8, docs, 8 * blocks + 16 * docs)
        self.docs = [None if x else int(i) for i, x in zip(ids, null)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        base = self.starts[a]
        self.f.seek(int(base))
        data = self.f.read(int(self.starts[b] - base))
        out = np.concatenate([unpack(data, int(s - base)) for s in self.starts[a:b]])
        return out[start - a * BLOCK:stop - a * BLOCK]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """``(doc_id, ids)`` in file order, some blocks of many documents at a time."""
        i, at = 0, 0
        while i < len(self.docs):
            j = max(i + 1, int(np.searchsorted(self.ends, at + 256 * BLOCK, "right")))
            ids, base = self.ids(at, int(self.ends[j - 1])), at
            for k in range(i, j):
                yield self.docs[k], ids[at - base:int(self.ends[k]) - base]
                at = int(self.ends[k])
            i = j


def sized(batches, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ids and texts cut into slices of less than ``size`` bytes of text, beside
    each slice's first text."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), b.num_rows]
        for i, j in zip(at, at[1:]):
            if j > i:
                yield b.slice(i, j - i)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write files under ``path`` in
    ascending id order. Returns the manifest ``(part, file, size, docs, ids)``.

    NULL texts are empty (the end id alone). NULL ids come first; rows with one
    id follow each other in the order of their text's hash, repeated rows each
    count. Ids must be integers; other columns are ignored. An empty table has
    no file.
    """
    tokenizer = tokenizer or tokens.tokenizer_path(tokens.WORD_BPE)

    def run(batches):
        encoder, writer, out = None, None, None
        fs, root = pafs.FileSystem.from_uri(path)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.pfr"
        end = np.array([end_id], "<u4")
        for b in sized(batches):
            if writer is None:
                encoder = tokens.worker_encoder(tokenizer)
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}")
                writer = Writer(out)
            for i, ids in zip(b.column(0).to_pylist(), encoder.encode_all(pc.fill_null(b.column(1), ""))):
                writer.add(i, np.append(ids, end))
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"{path}/{name}"], "size": [writer.at],
                                              "docs": [len(writer.docs)], "ids": [writer.n]})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    ordered = hashed.repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    return cut(ordered.mapInArrow(run, "part long, file string, size long, docs long, ids long"))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Read the manifest's files back: ``(doc_id, start, n_tokens, ids_crc32)`` per document.

    ``start`` counts the ids of all documents before it, over all files (a
    prefix sum over the manifest, one row per file). Each file is read by one
    task, a few blocks at a time.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "file", "size", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    width = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, at = pafs.FileSystem.from_uri(r["file"])
                with fs.open_input_file(at) as f:
                    start, out = r["start"], ([], [], [], [])
                    for doc, ids in Reader(f, r["size"]).documents():
                        for column, x in zip(out, (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))):
                            column.append(x)
                        start += len(ids)
                        if len(out[0]) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], NAMES)
                            out = ([], [], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], NAMES)

    return files.repartition(width, "part").mapInArrow(run, ", ".join(f"{n} long" for n in NAMES))


NAMES = ["doc_id", "start", "n_tokens", "ids_crc32"]


def token_files(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files (to a new shared folder unless ``path`` is given) and read them back."""
    return read_tokens(write_tokens(docs, path or scratch(docs.sparkSession, "tokens"), **options))
