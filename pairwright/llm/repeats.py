"""Removal of long repeated byte strings, filed under their least q-gram and compared by hashes.

A string of `length` bytes is repeated if it starts at two places of the corpus. This is winnowing, not the refinement of
buckets of all suffixes in rounds, which needs a row for each byte and round (25 times the input in one shuffle). Places
fall into buckets, and buckets are split:

1. Every place has the identifier of its q-gram. A string of `length` bytes is filed under the least identifier within
   it, so equal strings are filed under the same bucket at the same offset, and neighbouring strings that are filed at
   one place form a run. Only runs, about one for a hundred bytes, become rows.
2. A run is refined by the identifiers at its later offsets, which together are its text. Equal runs are repeated as a
   whole. A bucket that holds one run only is done with.
3. Where a bucket holds different runs, one of each kind is refined string by string, again by the identifiers at later
   offsets, which are looked up and not read again. Strings that meet another are repeated.

Identifiers are hashes of 64 bits, compared only within a bucket of another 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from pairwright.llm.common import cut, mixed, pieces, plain

#: Runs of one bucket that are compared at once; a bucket with more is split by the identifiers of its strings.
BUCKET = 1024
_PLACE_BITS = 20
_PLACES = (1 << _PLACE_BITS) - 1
_FACTOR = 0x9E3779B97F4A7C15
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _byte_values() -> np.ndarray:
    return np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_VALUES = _byte_values()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor of the rolling hash, and of its inverse; at most as many as a stretch has bytes."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, 1 << 16)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = np.uint64(_FACTOR), np.uint64(pow(_FACTOR, -1, 1 << 64))
        _powers[:] = [(np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))]
    return _powers[0]


def gram_ids(data: np.ndarray, gram: int) -> np.ndarray:
    """The identifier of the q-gram at each place."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=sums[1:])
    n = len(data) - gram + 1
    return mixed((sums[gram:] - sums[:n]) * down[:n])


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n = len(x)
    padded = np.concatenate([x, np.full(-n % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def stretches(n: int, length: int) -> Iterator[tuple[int, int]]:
    """(start, end) of overlapping stretches of a text, each string of `length` bytes within just one. They bound memory."""
    step = (1 << _PLACE_BITS) - length
    for start in range(0, max(n - length + 1, 0), step):
        yield start, min(n, start + step + length - 1)


def string_ids(ids: np.ndarray, start: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Identifiers of the strings of `length` bytes at these places, from those of their q-grams at later offsets."""
    out = ids[start]
    for offset in [*range(gram, length - gram, gram), length - gram]:
        out = mixed(out * np.uint64(_FACTOR) + ids[start + offset])
    return out


def runs(ids: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first, last, bucket, kind) of each run of strings that are filed at one place; kind identifies the run's text."""
    places = np.arange(len(ids), dtype=np.uint64)
    low = np.uint64(_PLACES)
    least = window_least((ids & ~low) | places, length - gram + 1)
    at = (least & low).astype(np.int64)
    edges = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], edges])
    last = np.concatenate([edges, [len(at)]]) - 1
    at = at[first]
    kind = mixed(string_ids(ids, first, length, gram) * np.uint64(_FACTOR) + string_ids(ids, last, length, gram))
    middle = np.minimum(first + gram, last)
    kind = mixed(kind + string_ids(ids, middle, length, gram))
    kind = mixed(kind + ((at - first).astype(np.uint64) << np.uint64(32)) + (last - first).astype(np.uint64))
    return first, last, ids[at], kind


_RUNS = "doc_id {0}, body bigint, first bigint, last bigint, bucket bigint, kind bigint"


def _find_runs(length: int, gram: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            rows, made = [], []
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(2)[row].as_buffer() or b"", np.uint8)
                for start, end in stretches(len(data), length):
                    first, last, bucket, kind = runs(gram_ids(data[start:end], gram), length, gram)
                    made.append((first + start, last + start, bucket, kind))
                    rows.append(np.full(len(first), row))
            if made:
                first, last, bucket, kind = (np.concatenate(x) for x in zip(*made, strict=True))
                rows = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(first), pa.array(last),
                     pa.array(bucket.view(np.int64)), pa.array(kind.view(np.int64))],
                    names=["doc_id", "body", "first", "last", "bucket", "kind"])

    return find


def _find_strings(length: int, gram: int):
    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = ["bucket", "slot", "doc_id", "body", "whole", "ids", "first", "steps"]
        step = _steps(length - gram)
        for batch in pieces(batches, 64):
            out: list[list] = [[] for _ in names]
            for row in range(batch.num_rows):
                data = np.frombuffer(unpack(batch.column(2)[row].as_py()), np.uint8)
                wanted = sorted(batch.column(3)[row].as_py(), key=lambda r: r["first"])
                todo = iter(wanted)
                run = next(todo, None)
                for start, end in stretches(len(data), length):
                    stop = end - length + 1
                    if run is None:
                        break
                    if run["first"] >= stop:
                        continue
                    ids = gram_ids(data[start:end], gram)
                    while run is not None and run["first"] < stop:
                        places = np.arange(run["first"], run["last"] + 1)
                        found = string_ids(ids, places - start, length, gram)
                        slots = (found % np.uint64(run["slots"])).astype(np.int64)
                        for slot in np.unique(slots).tolist() if run["slots"] > 1 else [0]:
                            own = slots == slot
                            for k, x in enumerate((run["bucket"], slot, batch.column(0)[row], batch.column(1)[row].as_py(), run["whole"],
                                                   found[own].tobytes(), run["first"], (places[own] - run["first"]).astype(step).tobytes())):
                                out[k].append(x)
                        run = next(todo, None)
            if out[0]:
                kinds = [pa.int64(), pa.int64(), batch.column(0).type, pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary()]
                out[2] = [x.as_py() for x in out[2]]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    return find


def _steps(most: int) -> np.dtype:
    """Places within a run are written as steps from its first, in as many bytes as a run's length needs."""
    return np.dtype("<u2" if most < 1 << 16 else "<u4")


def _spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of the runs of neighbouring places."""
    breaks = np.flatnonzero(np.diff(places) != 1)
    return places[np.concatenate([[0], breaks + 1])], places[np.concatenate([breaks, [len(places) - 1]])]


def _meet(step: np.dtype, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by bucket and slot: strings that meet another one. Of each different string seen, one place is held."""
    key: tuple[int, int] | None = None
    seen = seen_place = seen_owner = np.empty(0, np.uint64)
    owners: list[tuple] = []

    for batch in batches:
        if not batch.num_rows:
            continue
        bucket, slot = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        edges = [0, *(np.flatnonzero((np.diff(bucket) != 0) | (np.diff(slot) != 0)) + 1).tolist(), batch.num_rows]
        out: list[tuple] = []
        for s, e in zip(edges, edges[1:], strict=False):
            if (int(bucket[s]), int(slot[s])) != key:
                key = (int(bucket[s]), int(slot[s]))
                seen = seen_place = np.empty(0, np.uint64)
                seen_owner, owners = np.empty(0, np.int64), []
            for low in range(s, e, BUCKET):
                part = batch.slice(low, min(BUCKET, e - low))
                ids = [np.frombuffer(x.as_buffer(), np.uint64) for x in part.column(5)]
                firsts = part.column(6).to_pylist()
                places = np.concatenate([np.frombuffer(x.as_buffer(), step).astype(np.int64) + f for x, f in zip(part.column(7), firsts, strict=True)]).view(np.uint64)
                new = list(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True))
                owner = np.repeat(np.arange(len(owners), len(owners) + len(new)), [len(x) for x in ids])
                owners += new
                every = np.concatenate([seen, *ids])
                at_place = np.concatenate([seen_place, places])
                at_owner = np.concatenate([seen_owner, owner])
                order = np.argsort(every, kind="stable")
                ranked = every[order]
                same = ranked[1:] == ranked[:-1]
                twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
                hit = np.sort(order[twice])
                hit_owner, hit_place = at_owner[hit], at_place[hit].view(np.int64)
                by_owner = np.lexsort((hit_place, hit_owner))
                hit_owner, hit_place = hit_owner[by_owner], hit_place[by_owner]
                for a, b in zip(*(lambda c: (np.concatenate([[0], c]), np.concatenate([c, [len(hit_owner)]])))(np.flatnonzero(np.diff(hit_owner)) + 1), strict=True):
                    if b > a:
                        doc, body, whole = owners[hit_owner[a]]
                        if not whole:
                            out.extend((doc, body, f, t) for f, t in zip(*(x.tolist() for x in _spans(hit_place[a:b])), strict=True))
                first = order[np.concatenate([[True], ~same])]
                seen, seen_place, seen_owner = every[first], at_place[first], at_owner[first]
                kept, seen_owner = np.unique(seen_owner, return_inverse=True)
                owners = [owners[k] for k in kept.tolist()]
        if out:
            doc, body, first, last = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(doc, batch.column(2).type), pa.array(body, pa.int64()), pa.array(first, pa.int64()),
                                              pa.array(last, pa.int64())], names=["doc_id", "body", "first", "last"])


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in pieces(batches, 256):
        packed = [pack(x.as_buffer() or b"") for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "body", "packed"])


def covered(n: int, spans: list[dict], length: int) -> np.ndarray:
    """Whether each byte is within a string of `length` bytes that starts in one of the spans."""
    step = np.zeros(n + 1, np.int32)
    for s in spans:
        step[s["first"]] += 1
        step[s["last"] + length] -= 1
    return np.cumsum(step[:-1]) > 0


def _remove(length: int):
    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 64):
            out: list[list] = [[] for _ in names[1:]]
            for row in range(batch.num_rows):
                raw = unpack(batch.column(1)[row].as_py())
                spans = batch.column(2)[row].as_py() or []
                kept, gone, n_spans = raw, 0, 0
                if spans:
                    inside = covered(len(raw), spans, length)
                    kept = np.frombuffer(raw, np.uint8)[~inside].tobytes()
                    gone = len(raw) - len(kept)
                    n_spans = int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum())
                for k, x in enumerate((kept, len(raw), gone, n_spans, hashlib.sha256(kept).hexdigest())):
                    out[k].append(x)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, k) for x, k in zip(out, kinds, strict=True)]], names=names)

    return remove


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, body and the compressed text. Both joins take this one table, whose body is never null, so that Spark sees
    one shuffle in them and writes it once; a key that might be null would be filtered in the inner join alone."""
    return docs.mapInArrow(_pack, T.StructType([
        docs.schema["doc_id"], T.StructField("body", T.LongType(), False), T.StructField("packed", T.BinaryType())]))


def repeated_spans(docs: DataFrame, packed: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, body, first, last): starts of repeated strings. `docs` has doc_id, body, bytes.

    Copies of a run are counted with a combining aggregation and told to its places by a plain join with one row for
    each kind on one side, which may be split; texts are shuffled once, for the documents' own rows only, compressed.
    """
    kind_of = docs.schema["doc_id"].dataType.simpleString()
    all_runs = cut(docs.mapInArrow(_find_runs(length, gram), _RUNS.format(kind_of)))
    kinds = cut(all_runs.groupBy("bucket", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("body").alias("chosen")))
    buckets = kinds.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_kinds")).where("n_kinds > 1")
    told = kinds.join(buckets, "bucket", "left").where("n > 1 or n_kinds > 1")
    alive = cut(all_runs.join(told, ["bucket", "kind"]).select(
        "doc_id", "body", "first", "last", "bucket", (F.col("n") > 1).alias("whole"), "n_kinds",
        (F.col("n_kinds").isNotNull() & ((F.col("n") == 1) | (F.col("body") == F.col("chosen")))).alias("refine")))
    wanted = alive.where("refine").groupBy("doc_id", "body").agg(F.collect_list(F.struct(
        "first", "last", "bucket", "whole", F.ceil(F.col("n_kinds") / BUCKET).cast("long").alias("slots"))).alias("runs"))
    strings = joined(packed, wanted, "inner").select("doc_id", "body", "packed", "runs").mapInArrow(
        _find_strings(length, gram),
        f"bucket bigint, slot bigint, doc_id {kind_of}, body bigint, whole boolean, ids binary, first bigint, steps binary")
    met = (
        strings.repartition("bucket", "slot").sortWithinPartitions("bucket", "slot")
        .mapInArrow(partial(_meet, _steps(length - gram)), f"doc_id {kind_of}, body bigint, first bigint, last bigint")
    )
    return alive.where("whole").select("doc_id", "body", "first", "last").union(met)


def joined(packed: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Packed texts with what belongs to them."""
    right = other.withColumnsRenamed({"doc_id": "_doc", "body": "_body"})
    return packed.alias("d").join(right, (F.col("d.body") == F.col("_body")) & F.col("d.doc_id").eqNullSafe(F.col("_doc")), how)


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 200, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans, kept_sha256 for every row.

    A byte goes if a string of `length` bytes over it starts at another place too, in the same text or another; matches
    are within one text and judged on the input. Null texts are empty; texts shorter than `length` stay whole; very
    long texts are worked on in overlapping stretches; repeated rows are copies of each other and go whole if long
    enough; null ids are ids like any other. An empty table gives an empty table; further columns are ignored.
    `gram` is at most half of `length`.
    """
    if not 0 < 2 * gram <= length:
        raise ValueError("gram must be at most half of length")
    body = F.coalesce(plain(text), F.lit(""))
    read = docs.select(plain(id).alias("doc_id"), F.xxhash64(plain(id), body).alias("body"), F.encode(body, "UTF-8").alias("bytes"))
    packed = packed_texts(read)
    spans = repeated_spans(read, packed, length, gram).distinct().groupBy("doc_id", "body").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    kind_of = read.schema["doc_id"].dataType.simpleString()
    return joined(packed, spans, "left").select("doc_id", "packed", "spans").mapInArrow(
        _remove(length), f"doc_id {kind_of}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
