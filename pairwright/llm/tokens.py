"""Token ids in files of independent zstandard frames, with a document index and a trailing seek table.

File: frames of token ids (little-endian, two or four bytes each), each a zstandard frame of its own with a content
checksum; one frame with the index of the documents (id, frame, first token in the frame, number of tokens); then the
seek table, a skippable frame with the compressed and raw size and a checksum of every frame before it. A reader takes
the seek table from the end, the index, and then only the frames that hold the documents asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from pairwright.llm.common import cut, pieces, plain, shared_dir
from pairwright.llm.encoding import encoder

#: Fixed values of the seekable zstandard format: magic of the skippable frame and of the footer, checksum flag.
SKIPPABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_TOKENS = 1 << 16
_NULL = -(1 << 63)
_INDEX = np.dtype([("doc", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("n", "<u8")])

class Writer:
    """Writes documents in the order given. `width`: bytes of an id in the file."""

    def __init__(self, out: BinaryIO, width: int, level: int = 3, frame_tokens: int = FRAME_TOKENS):
        self.out, self.frame_tokens = out, frame_tokens
        self.kind = np.dtype("<u2" if width == 2 else "<u4")
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.n_docs = self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """A document may run over several frames; its index names the first."""
        self.docs.append((_NULL if doc_id is None else doc_id, len(self.frames), self.n_held, len(ids)))
        self.n_docs += 1
        self.n_tokens += len(ids)
        while len(ids):
            room = self.frame_tokens - self.n_held
            self.held.append(ids[:room].astype(self.kind))
            self.n_held += len(self.held[-1])
            ids = ids[room:]
            if self.n_held == self.frame_tokens:
                self._flush()

    def _flush(self) -> None:
        if self.n_held:
            self._frame(np.concatenate(self.held).tobytes())
            self.held, self.n_held = [], 0

    def _frame(self, raw: bytes) -> None:
        packed = self.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        self._flush()
        self._frame(np.array(self.docs, _INDEX).tobytes() + struct.pack("<B", self.kind.itemsize))
        entries = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class Reader:
    """Reads documents of one file; `source` has seek and read. Only frames that are asked for are decompressed."""

    def __init__(self, source: BinaryIO):
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != FOOTER_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table at the end")
        source.seek(size - 9 - 12 * count)
        self.frames = [struct.unpack("<III", source.read(12)) for _ in range(count)]
        self.at = np.concatenate([[0], np.cumsum([f[0] for f in self.frames])]).tolist()
        self.decompress = zstandard.ZstdDecompressor().decompress
        raw = self._raw(count - 1)
        self.kind = np.dtype("<u2" if raw[-1] == 2 else "<u4")
        self.index = np.frombuffer(raw[:-1], _INDEX)
        self.read_frames = 0
        self._kept: tuple[int, np.ndarray] = (-1, np.empty(0, self.kind))

    def _raw(self, frame: int) -> bytes:
        self.source.seek(self.at[frame])
        raw = self.decompress(self.source.read(self.frames[frame][0]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[frame][2]:
            raise ValueError(f"frame {frame} does not match its checksum")
        return raw

    def _tokens(self, frame: int) -> np.ndarray:
        if self._kept[0] != frame:
            self._kept = (frame, np.frombuffer(self._raw(frame), self.kind))
            self.read_frames += 1
        return self._kept[1]

    def document(self, row: int) -> np.ndarray:
        """The ids of the document in this row of the index."""
        entry = self.index[row]
        frame, first, left = int(entry["frame"]), int(entry["first"]), int(entry["n"])
        out = []
        while left:
            part = self._tokens(frame)[first:first + left]
            out.append(part)
            left -= len(part)
            frame, first = frame + 1, 0
        return np.concatenate(out).astype("<u4") if out else np.empty(0, "<u4")

    def documents(self, doc_ids: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        wanted = np.flatnonzero(np.isin(self.index["doc"], np.array(list(doc_ids), np.int64)))
        return ((int(self.index["doc"][row]), self.document(row)) for row in wanted.tolist())


def _open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """Any store that pyarrow reaches by address (file, hdfs, s3, gs); plain paths are local."""
    return pafs.FileSystem.from_uri(uri)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id: str = "doc_id", text: str = "text",
                 level: int = 3, parts: int | None = None) -> DataFrame:
    """Writes the files and returns their manifest: part, file, n_docs, n_tokens.

    Documents are dealt out by ranges of their id and sorted, so files in order of `part` hold ids in ascending order;
    rows with one id are ordered by text. Each try of a task writes a file of its own name; the manifest, written in
    one piece by Spark, names those that count. A task holds one frame, the index of its file and one batch of texts.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        encode = encoder(tokenizer)
        store, root = _open_store(folder)
        width = 2 if max(encode.vocabulary, end_id + 1) <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        writer, stream, name = None, None, f"part-{part:06d}-{uuid.uuid4().hex}.tok.zst"
        end = np.array([end_id], "<u4")
        for batch in batches:
            for rows in pieces([batch], 2048):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = Writer(stream, width, level)
                ids, counts = encode.encode(rows.column(1))
                at = 0
                for doc_id, n in zip(rows.column(0).to_pylist(), counts.tolist(), strict=True):
                    writer.add(doc_id, np.concatenate([ids[at:at + n], end]))
                    at += n
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([name]), pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_tokens], pa.int64())],
                names=["part", "file", "n_docs", "n_tokens"],
            )

    read = docs.select(plain(id).cast("long").alias("doc_id"), plain(text).alias("text"))
    keys = [F.col("doc_id").asc_nulls_first()]
    n = parts or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = read.repartitionByRange(n, *keys).sortWithinPartitions(*keys, F.col("text").asc_nulls_first())
    return cut(ordered.mapInArrow(run, "part bigint, file string, n_docs bigint, n_tokens bigint"))


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document, in its place: doc_id, start, n_tokens, ids_crc32. Files are read by their frames."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, root = _open_store(folder)
                with store.open_input_file(f"{root}/{file}") as source:
                    reader = Reader(source)
                    doc, n = reader.index["doc"], reader.index["n"].astype(np.int64)
                    start = offset + np.cumsum(n) - n
                    for first in range(0, len(doc), 4096):
                        rows = range(first, min(first + 4096, len(doc)))
                        crc = [zlib.crc32(reader.document(r).tobytes()) for r in rows]
                        s = slice(first, first + 4096)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc[s], mask=doc[s] == _NULL), pa.array(start[s]), pa.array(n[s]), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n, "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 2, id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """Writes all texts as token files and reads them back: doc_id, start, n_tokens (with the end id), ids_crc32.

    Null and empty texts have the end id only; very long texts run over several frames; repeated rows and equal ids keep
    a row each, ordered by text; null ids come first. An empty table writes no file and gives an empty table; further
    columns are ignored.
    """
    folder = folder or shared_dir(docs.sparkSession)
    return read_index(write_tokens(docs, folder, tokenizer, end_id, id, text), folder)


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (array) of a few documents asked for by id, decompressing only the frames that hold them."""
    wanted = list(doc_ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, root = _open_store(folder)
                with store.open_input_file(f"{root}/{file}") as source:
                    for doc, ids in Reader(source).documents(wanted):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc], pa.int64()), pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    return manifest.select("file").mapInArrow(run, "doc_id bigint, ids array<bigint>")
