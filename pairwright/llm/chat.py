"""Chat formatting: typed content parts flattened by a visitor, marked turns, a loss mask, and a reader.

Each row is one turn. Turns are formatted apart from each other, so a conversation of any length needs no task of its
own; the formatted conversation is its segments in order of turn.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import plain

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
_ADD, _TAKE = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
_SEGMENT = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)

PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
_ATTACHED = pa.list_(pa.struct([("type", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())]))
_OUT = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("segment", pa.string()), ("loss_start", pa.int64()),
    ("loss_end", pa.int64()), ("attachments", _ATTACHED),
])
SEGMENTS = (
    "conv_id bigint, turn bigint, segment string, loss_start bigint, loss_end bigint,"
    "attachments array<struct<type:string,ref:string,at:bigint,tokens:bigint>>"
)


def escape(text: str) -> str:
    """No `<|` is left: every `<`, backslashes, `|` gets one backslash more."""
    return _ADD.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _TAKE.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Sizes:
    """Tokens that a part stands for: image patches, audio frames a second, tokens a page."""

    patch: int = 14
    merge: int = 2
    audio_per_second: float = 25.0
    page_tokens: int = 1024
    least: int = 1


@dataclass
class Flatten:
    """The visitor: walks the parts of one turn in order, one method for each type."""

    sizes: Sizes
    out: list[str] = field(default_factory=list)
    length: int = 0
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_unknown)(part)

    def _put(self, text: str) -> None:
        self.out.append(text)
        self.length += len(text)

    def _attach(self, kind: str, part: dict, tokens: float) -> None:
        count = max(self.sizes.least, math.ceil(tokens))
        self.attachments.append({"type": kind, "ref": part.get("ref"), "at": self.length, "tokens": count})
        self._put(f"<|{kind}|>")

    def visit_text(self, part: dict) -> None:
        self._put(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        cell = self.sizes.patch * self.sizes.merge
        self._attach("image", part, math.ceil((part.get("width") or 0) / cell) * math.ceil((part.get("height") or 0) / cell))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, (part.get("seconds") or 0) * self.sizes.audio_per_second)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.sizes.page_tokens)

    def visit_unknown(self, part: dict) -> None:
        self.visit_text(part)


def format_turn(role: str | None, parts: list[dict], sizes: Sizes, learn: frozenset[str]) -> tuple[str, int, int, list[dict]]:
    """(segment, start and end of what is learned, attachments). Offsets in code points of the segment."""
    flat = Flatten(sizes)
    for part in parts:
        flat.visit(part)
    head = f"{OPEN}{escape_role(role or '')}\n"
    body = "".join(flat.out)
    end = len(head) + (len(body) if (role or "") in learn else 0)
    attached = [a | {"at": a["at"] + len(head)} for a in flat.attachments]
    return f"{head}{body}{CLOSE}\n", len(head), end, attached


def format_chats(turns: DataFrame, sizes: Sizes = Sizes(), learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn: conv_id, turn, segment, loss_start, loss_end (equal: nothing is learned), attachments.

    Reads `parts` (see PARTS) where the table has it and it is not null, else `text` as one text part. Null texts and
    roles are empty, an unknown part type is read as text, a null conv_id or turn stays null. Repeated rows stay; an
    empty table gives an empty table; further columns are ignored. No shuffle.
    """
    chosen = frozenset(learn)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                out = []
                for row in batch.slice(start, 1024).to_pylist():
                    parts = row["parts"] if row["parts"] is not None else [{"type": "text", "text": row["text"]}]
                    segment, begin, end, attached = format_turn(row["role"], [p for p in parts if p], sizes, chosen)
                    out.append((row["conv_id"], row["turn"], segment, begin, end, attached))
                yield pa.RecordBatch.from_pylist([dict(zip(_OUT.names, x, strict=True)) for x in out], schema=_OUT)

    has_parts = "parts" in turns.columns
    read = turns.select(
        plain("conv_id").cast("long").alias("conv_id"), plain("turn").cast("long").alias("turn"), plain("role").alias("role"),
        plain("text").alias("text"), (plain("parts").cast(PARTS) if has_parts else F.lit(None).cast(PARTS)).alias("parts"),
    )
    return read.mapInArrow(run, SEGMENTS)


def read_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn; placeholders stay in the text."""
    found = _SEGMENT.fullmatch(segment)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape_role(found[1]), unescape(found[2])


_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def digest_chats(segments: DataFrame, reader: Callable[[str], tuple[str, str]] = read_segment) -> DataFrame:
    """One row per conversation, read back from its segments in order of turn (null first), then segment.

    A conversation is one stream of bytes to its hash, so its turns meet in one task; they pass through it sorted, one
    at a time, and nothing is held but the state of the hashes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key: object = run  # no conversation yet
        state: list = []

        def close() -> None:
            if key is not run:
                out.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist([dict(zip(_DIGEST.names, x, strict=True)) for x in out], schema=_DIGEST)
            out.clear()
            return made

        for batch in batches:
            columns = (batch.column(k).to_pylist() for k in range(4))
            for conv, segment, begin, end in zip(*columns, strict=True):
                if conv != key:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = reader(segment)
                learned = unescape(segment[begin:end])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                state[2] += len(learned)
                state[3].update(learned.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
            if len(out) > 1000:
                yield flush()
        close()
        yield flush()

    ordered = segments.select("conv_id", "segment", "loss_start", "loss_end", "turn").repartition(F.col("conv_id"))
    ordered = ordered.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
