"""SimHash near-duplicates: fingerprints of word shingles, linked by Hamming distance.

Fingerprints are split into blocks. Two that differ in at most `distance` bits agree in all but `distance` blocks, so
they agree in at least one choice of `blocks - distance` blocks; each choice is a key. The fingerprints of one key are
compared within a task, and only a spanning forest of the links leaves it, so no link is missed and no pair of a group is
written out. Components of the links are the groups of near copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import cut, fresh, pieces, plain, row_hashes, words_of
from pairwright.llm.components import components

#: The hash and its seed are those of the query contract.
SEED = 42
_CHUNK = 1 << 14


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of `width` words joined by a space; of the whole text where it has fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1:].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in pairs), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 where more than half the hashes have it."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _CHUNK):
        part = hashes[start:start + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, width: int = 5, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` and `fp`, the fingerprint as a signed long. Null and empty texts have fingerprint 0. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            texts = batch.column(batch.num_columns - 1)
            made = [fingerprint(shingle_hashes(words_of(t.as_py()), width)) for t in texts]
            fp = pa.array(np.array(made, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fp], names=[*keep, "fp"])

    read = docs.select(*[plain(c) for c in keep], plain(text).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-1])
    return read.mapInArrow(run, f"{kinds}, fp bigint")


def block_bounds(blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, number of bits) of each block."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def choose_blocks(rows: int, distance: int) -> int:
    """The fewest blocks whose keys have more values than there are rows; any number gives the same links."""
    blocks = distance + 1
    while blocks < distance + 4 and 64 * (blocks - distance) / blocks < np.log2(max(rows, 2)):
        blocks += 1
    return blocks


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct values: each value found hangs on the smallest of its tree.

    A search in width: a value leaves the rest when it is found, and a search ends when no rest is left, so a dense
    group of n costs about n comparisons times the few steps to its rim, not n squared. A group that several keys find
    whole gives the same links each time.
    """
    rest = np.argsort(values)
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    while len(rest) > 1:
        root, rest = int(rest[0]), rest[1:]
        queue = [root]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(values[rest] ^ values[at]) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                left.append(np.full(len(found), root))
                right.append(found)
                queue.extend(found.tolist())
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def near_links(distinct: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(a, b): links that join just what all links of at most `distance` bits join. `distinct` has one row per `fp`."""
    bounds = block_bounds(blocks)
    masks = [
        (lambda m: m - (1 << 64) if m >> 63 else m)(sum(((1 << n) - 1) << low for low, n in choice))
        for choice in combinations(bounds, blocks - distance)
    ]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "part"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by key: the values of a key, eight bytes each, are gathered and compared."""
        names = ["a", "b"]
        held: list[np.ndarray] = []
        last: tuple[int, int] | None = None

        def linked(values: np.ndarray) -> pa.RecordBatch | None:
            if len(values) < 2:
                return None
            a, b = forest(values, distance)
            if not len(a):
                return None
            signed = values.view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(signed[a]), pa.array(signed[b])], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            choice = batch.column(1).to_numpy(zero_copy_only=False)
            part = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (part[1:] != part[:-1])) + 1
            edges = [0, *cuts.tolist(), len(fp)]
            made: list[pa.RecordBatch] = []
            for s, e in zip(edges, edges[1:], strict=False):
                key = (int(choice[s]), int(part[s]))
                if key != last:
                    if len(held) > 1 or held and len(held[0]) > 1:
                        made.append(linked(np.concatenate(held)))
                    held, last = [], key
                held.append(fp[s:e].copy())
            yield from (m for m in made if m is not None)
        if held and (m := linked(np.concatenate(held))) is not None:
            yield m

    dealt = keyed.repartition("choice", "part").sortWithinPartitions("choice", "part")
    return dealt.select("fp", "choice", "part").mapInArrow(run, "a bigint, b bigint").distinct()


def _classes(distinct: DataFrame, distance: int, blocks: int | None) -> DataFrame:
    """The rows of `distinct`, one for each `fp`, with `root`, which names their component."""
    roots = components(near_links(distinct, distance, blocks or choose_blocks(distinct.count(), distance)))
    return distinct.join(roots, distinct.fp == roots.node, "left").select(*distinct.columns, F.coalesce("root", "fp").alias("root"))


def near_fingerprints(docs: DataFrame, width: int = 4, distance: int = 4, id: str = "doc_id", text: str = "text",
                      blocks: int | None = None) -> DataFrame:
    """doc_id, fp, component_id: the smallest id reachable over links of at most `distance` bits, itself included.

    Every such link counts: blocks are chosen so that no pair can be missed. Null and empty texts have fingerprint 0 and
    link like any other; a very long text is read whole; ties and repeated rows share a fingerprint and a component; a
    null id counts only where a component has no other. An empty table gives an empty table, and further columns are
    ignored. Documents are grouped by fingerprint before anything is compared, so copies cost one fingerprint; only
    fingerprints, links and roots are shuffled, never texts.
    """
    marked = cut(fingerprints(docs.select(plain(id).alias("doc_id"), plain(text).alias("text")), width))
    classes = _classes(cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id"))), distance, blocks)
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_fp = cut(classes.join(least, "root").select("fp", "component_id"))
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of `near_fingerprints`, all columns as they are: the one with the smallest id.

    Rows are told apart by hashes of all their columns (maps aside), not by their id: of several rows with the smallest
    id, or of several without any id where there is no other, the one with the smallest hashes stays, the same on a
    rerun; of rows equal in every column one stays. Rows whose texts are null, empty or without a word are one
    component. An empty table stays empty; column names may clash with none used here. Texts pass one shuffle, by hash,
    repeats merged before it.
    """
    first, second = row_hashes(docs)
    named = docs.select(plain(id).isNull().alias("no_id"), plain(id).alias("doc_id"), first.alias("first"), second.alias("second"),
                        plain(text).alias("text"))
    order = ("no_id", "doc_id", "first", "second")
    marked = cut(fingerprints(named, width, keep=order))
    classes = _classes(cut(marked.groupBy("fp").agg(F.min(F.struct(*order)).alias("least"))), distance, None)
    stay = classes.groupBy("root").agg(F.min("least").alias("least")).select("least.first", "least.second")
    columns = docs.columns
    at, other = fresh(columns, "_first"), fresh(columns, "_second")
    hashed = docs.withColumns({at: first, other: second}).dropDuplicates([at, other])
    same = (hashed[at] == stay["first"]) & (hashed[other] == stay["second"])
    return hashed.join(stay, same, "left_semi").select(*[plain(c) for c in columns])
