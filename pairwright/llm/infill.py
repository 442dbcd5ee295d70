"""Fill-in-the-middle transformation over texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of whole code points. Each frame carries what lies before it: bytes,
code points and line ends. Two cuts are chosen from hashes of the document's id; their places are found by the cumulative
counts, and only the frames that hold a cut are decompressed. Everything longer than a frame (the transformed text, its
digest, the text rebuilt from it) streams through frames in order, so memory beyond the compressed text is that of a
frame or two, whatever the length of a document.

A unit is a line with its end, or what follows the last line end.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import pieces, plain

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FRAME_BYTES = 1 << 16
PLAIN, PSM, SPM = "plain", "psm", "spm"

_FRAMES = pa.list_(pa.struct([("data", pa.binary()), ("bytes", pa.int64()), ("chars", pa.int64()), ("lines", pa.int64())]))
FRAMES = "array<struct<data: binary, bytes: bigint, chars: bigint, lines: bigint>>"


def _chars(data: bytes) -> int:
    """Code points of UTF-8: bytes that do not continue one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


@dataclass
class Frames:
    """A text as frames; `bytes`, `chars` and `lines` count what lies before each frame, with the totals at the end."""

    data: list[bytes] = field(default_factory=list)
    bytes: list[int] = field(default_factory=lambda: [0])
    chars: list[int] = field(default_factory=lambda: [0])
    lines: list[int] = field(default_factory=lambda: [0])
    opened: int = 0  # frames decompressed so far

    def open(self, k: int) -> bytes:
        self.opened += 1
        return zstandard.ZstdDecompressor().decompress(self.data[k])

    def span(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from `start` to `end`, frame by frame."""
        k = max(bisect_right(self.bytes, start) - 1, 0)
        while start < end:
            raw, before = self.open(k), self.bytes[k]
            yield raw[start - before:end - before]
            k, start = k + 1, self.bytes[k + 1]

    def chars_before(self, place: int) -> int:
        """Code points before a byte that starts one."""
        k = bisect_right(self.bytes, place) - 1
        inside = place - self.bytes[k]
        return self.chars[k] + (_chars(self.open(k)[:inside]) if inside else 0)

    @property
    def n_units(self) -> int:
        """Line ends, and one more if something follows the last."""
        if not self.data:
            return 0
        return self.lines[-1] + (not self.open(len(self.data) - 1).endswith(b"\n"))

    def after_units(self, n: int) -> int:
        """The byte after the first `n` units."""
        if n > self.lines[-1]:
            return self.bytes[-1]
        if not n:
            return 0
        k = bisect_left(self.lines, n) - 1  # the frame with line end number n
        ends = np.flatnonzero(np.frombuffer(self.open(k), np.uint8) == 10)
        return self.bytes[k] + int(ends[n - self.lines[k] - 1]) + 1

    def find(self, mark: bytes, start: int = 0) -> int:
        """The first place of `mark` from `start` on, also across frames, or -1."""
        tail, at = b"", start
        for part in self.span(start, self.bytes[-1]):
            joined = tail + part
            place = joined.find(mark)
            if place >= 0:
                return at - len(tail) + place
            at += len(part)
            tail = joined[-(len(mark) - 1):] if len(mark) > 1 else b""
        return -1


def store(parts: Iterable[bytes], size: int = FRAME_BYTES, level: int = 1) -> Frames:
    """Frames of about `size` bytes, each of whole code points, from a stream of UTF-8."""
    made, held = Frames(), b""
    compress = zstandard.ZstdCompressor(level=level).compress

    def put(raw: bytes) -> None:
        made.data.append(compress(raw))
        made.bytes.append(made.bytes[-1] + len(raw))
        made.chars.append(made.chars[-1] + _chars(raw))
        made.lines.append(made.lines[-1] + raw.count(b"\n"))

    for part in parts:
        for at in range(0, len(part), size):
            held += part[at:at + size]
            while len(held) >= size + 4:
                end = size
                while held[end] & 0xC0 == 0x80:
                    end -= 1
                put(held[:end])
                held = held[end:]
    if held:
        put(held)
    return made


def choices(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned numbers from the hash of the seed and the id; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def form_of(text: Frames, numbers: list[int], rate: int, spm: int) -> str:
    if not text.data or numbers[2] % 100 >= rate or any(text.find(m) >= 0 for m in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN
    return SPM if numbers[3] % 100 < spm else PSM


def cut_places(text: Frames, numbers: list[int], n: int) -> tuple[int, int]:
    """The bytes where prefix and middle end."""
    first, second = sorted(x % (n + 1) for x in numbers[:2])
    return text.after_units(first), text.after_units(second)


def arranged(text: Frames, form: str, first: int, second: int) -> Iterator[bytes]:
    """The transformed text as a stream."""
    if form == PLAIN:
        yield from text.span(0, text.bytes[-1])
        return
    prefix, suffix = (0, first), (second, text.bytes[-1])
    order = ((PREFIX, prefix), (SUFFIX, suffix)) if form == PSM else ((SUFFIX, suffix), (PREFIX, prefix))
    for mark, span in (*order, (MIDDLE, (first, second))):
        yield mark
        yield from text.span(*span)


def restored(output: Frames, form: str) -> Iterator[bytes]:
    """The text again, from the transformed text and its form alone."""
    end = output.bytes[-1]
    if form == PLAIN:
        yield from output.span(0, end)
        return
    start, turn = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    mid = output.find(turn, len(start))
    last = output.find(MIDDLE, mid + len(turn))
    one, two, middle = (len(start), mid), (mid + len(turn), last), (last + len(MIDDLE), end)
    prefix, suffix = (one, two) if form == PSM else (two, one)
    for span in (prefix, middle, suffix):
        yield from output.span(*span)


def _digest(parts: Iterable[bytes]) -> str:
    made = hashlib.sha256()
    for part in parts:
        made.update(part)
    return made.hexdigest()


def _to_arrow(stores: list[Frames]) -> pa.Array:
    """Each store as a list of frames; the totals follow from the last frame when it is read."""
    offsets = np.cumsum([0, *(len(s.data) for s in stores)])
    columns = [[x for s in stores for x in s.data], *([x for s in stores for x in getattr(s, c)[:-1]] for c in ("bytes", "chars", "lines"))]
    arrays = [pa.array(x, f.type) for x, f in zip(columns, _FRAMES.value_type, strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(arrays, fields=list(_FRAMES.value_type)))


def _from_arrow(value: pa.ListScalar) -> Frames:
    rows = value.as_py() or []
    made = Frames([r["data"] for r in rows], *([r[c] for r in rows] for c in ("bytes", "chars", "lines")))
    if not rows:
        return Frames()
    last = made.open(len(rows) - 1)
    made.bytes.append(made.bytes[-1] + len(last))
    made.chars.append(made.chars[-1] + _chars(last))
    made.lines.append(made.lines[-1] + last.count(b"\n"))
    return made


def store_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id and `frames`, the text of each row as independent frames with cumulative counts. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            stores = [store([x.as_buffer()] if x.is_valid else [], frame_bytes) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _to_arrow(stores)], names=["doc_id", "frames"])

    read = docs.select(plain(id).cast("long").alias("doc_id"), F.encode(plain(text), "UTF-8").alias("text"))
    return read.mapInArrow(run, f"doc_id bigint, frames {FRAMES}")


def infill(stored: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output from (doc_id, frames): `output` is the transformed text as frames.

    `rate` of 100 texts are transformed, `spm` of 100 of these with the suffix first; a text that is empty or holds a
    mark stays plain, with null lengths. Only frames that hold a cut are opened to choose.
    """
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            out: list[list] = [[] for _ in names[1:]]
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text, numbers = _from_arrow(value), choices(doc_id, seed)
                n, form = text.n_units, form_of(text, numbers, rate, spm)
                first, second = (0, 0) if form == PLAIN else cut_places(text, numbers, n)
                before, upto = (None, None) if form == PLAIN else (text.chars_before(first), text.chars_before(second))
                made = text if form == PLAIN else store(arranged(text, form, first, second), frame_bytes)
                for k, x in enumerate((n, form, before, None if upto is None else upto - before, made)):
                    out[k].append(x)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds, strict=False)], _to_arrow(out[-1])], names=names)

    return stored.select("doc_id", "frames").mapInArrow(
        run, f"doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output {FRAMES}")


def digests(made: DataFrame) -> DataFrame:
    """Of `infill`'s rows, the digest of the output and that of the text rebuilt from output and form, in place of the frames."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            whole, again = [], []
            for form, value in zip(batch.column(2).to_pylist(), batch.column(5), strict=True):
                output = _from_arrow(value)
                whole.append(_digest(output.span(0, output.bytes[-1])))
                again.append(_digest(restored(output, form)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(whole, pa.string()), pa.array(again, pa.string())], names=names)

    return made.select(*names[:5], "output").mapInArrow(
        run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")


def infill_digests(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 for every row.

    Null texts are empty; empty texts and texts that hold a mark are plain; a very long text is many frames, streamed; the
    choice depends on the id alone, so repeated rows come out alike and a null id counts as no digits. An empty table
    gives an empty table; further columns are ignored. No row is shuffled and nothing is written.
    """
    return digests(infill(store_texts(docs, id, text), seed, rate, spm))
