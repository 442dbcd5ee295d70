"""CSV files with line breaks in quoted cells, read in parallel by byte ranges.

Spark's text reader deals out the physical lines of a file by ranges of its bytes. Whether a range begins inside a
quoted cell depends on all quotes before it, so reading takes two passes:

1. Each range counts its quotes, and the records that start in it, for either case. A prefix scan over the ranges (one
   narrow row each) then tells which case holds and how many records start before.
2. Each range is cut into records at the line ends outside quotes. A record that runs over the end of its range leaves
   pieces, which are put together apart; there are at most two in a range.

Quotes follow RFC 4180: a cell that holds a quote, a comma or a line break is quoted, and a quote within it doubled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairwright.operators.numbering import sums_before
from pairwright.plans.lineage import cut

#: Ranges whose state may be broadcast, 24 bytes each; at 128 MB a range this is 128 TB of files.
MOST_RANGES = 1_000_000
_KEY = ("file", "start")


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(range, its lines, whether each has an odd number of quotes, whether it is blank), in order."""
    file, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
    lines = batch.column(2)
    odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
    blank = pc.is_in(lines, pa.array(["", "\r"])).to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1).tolist(), batch.num_rows]
    for s, e in zip(edges, edges[1:], strict=False):
        if e > s:
            yield (int(file[s]), int(start[s])), batch.slice(s, e - s), odd[s:e], blank[s:e]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range: whether its quotes are odd, and how many records start in it if it begins outside or inside a cell."""
    key, parity, starts = None, 0, [0, 0]

    def row() -> pa.RecordBatch:
        values = (*key, parity, *starts)
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=["file", "start", "odd", "outside", "inside"])

    for batch in batches:
        for own, _, odd, blank in _stretches(batch):
            if own != key:
                if key is not None:
                    yield row()
                key, parity, starts = own, 0, [0, 0]
            before = (np.cumsum(odd) - odd + parity) % 2
            starts[0] += int(((before == 0) & ~blank).sum())
            starts[1] += int(((before == 1) & ~blank).sum())
            parity = int((parity + odd.sum()) % 2)
    if key is not None:
        yield row()


def _cut_records(pieces: bool):
    """The records that lie within their range, or the pieces of those that do not: (file, start, position, opens, record)."""
    names = ["file", "start", "position", "opens", "record"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, coming, place, opens = None, 0, 0, -1, False  # the number of the next record, and of the open one
        held: list[str] = []

        def out(keys: list, positions: list, opened: list, records: pa.Array) -> pa.RecordBatch:
            file, start = zip(*keys, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(file, pa.int64()), pa.array(start, pa.int64()), pa.array(positions, pa.int64()),
                                               pa.array(opened, pa.bool_()), records.cast(pa.string())], names=names)

        def rest() -> Iterator[pa.RecordBatch]:
            if held and pieces:
                yield out([key], [place], [opens], pa.array(["\n".join(held)]))

        for batch in batches:
            states = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4).to_numpy(zero_copy_only=False)
            at = 0
            for own, part, odd, blank in _stretches(batch):
                if own != key:
                    yield from rest()
                    key, inside, coming, place, held, opens = own, int(states[0][at]), int(states[1][at]), -1, [], False
                at += part.num_rows
                after = (np.cumsum(odd) + inside) % 2
                before = np.concatenate([[inside], after[:-1]])
                lines = part.column(2)
                begins = (before == 0) & ~blank
                number = coming + np.cumsum(begins) - begins
                if not pieces and len(single := np.flatnonzero(begins & (after == 0))):
                    yield out([key] * len(single), number[single].tolist(), [True] * len(single), lines.take(pa.array(single)))
                made, places = [], []
                turns = np.flatnonzero(odd)
                start = 0 if inside else None  # where the open record goes on in this part
                for turn in turns.tolist():
                    if start is None:
                        start, opens, place, held = turn, True, int(number[turn]), []
                        continue
                    text = "\n".join([*held, *lines.slice(start, turn + 1 - start).to_pylist()])
                    if opens and not pieces:
                        made.append(text)
                        places.append(place)
                    if not opens and pieces:
                        yield out([key], [-1], [False], pa.array([text]))
                    start, held, opens, place = None, [], False, -1
                if start is not None:
                    held = held + lines.slice(start).to_pylist()
                if made:
                    yield out([key] * len(made), places, [True] * len(made), pa.array(made))
                inside = int(after[-1])
                coming = int(number[-1] + begins[-1])
        yield from rest()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(position, record) of all files under `path` but their first records: files in order of their paths, records in
    order within each. Blank lines between records are left out."""
    read = spark.read.option("lineSep", "\n").text(path)
    lines = read.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    paths = read.select(F.col("_metadata.file_path").alias("path")).distinct()
    counted = cut(lines.mapInArrow(_count, "file bigint, start bigint, odd bigint, outside bigint, inside bigint"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of one file
    ranges = counted.withColumn("within", F.pmod(F.coalesce(F.sum("odd").over(earlier), F.lit(0)), F.lit(2)))
    ranges = ranges.withColumn("n", F.when(F.col("within") == 0, F.col("outside")).otherwise(F.col("inside")))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    totals = paths.withColumn("file", F.xxhash64("path")).join(ranges.groupBy("file").agg(F.sum("n").alias("total")), "file")
    firsts = sums_before(totals, ["path"], {"total": "first"}).select("file", "first")
    states = cut(ranges.join(firsts, "file").select("file", "start", "within", (F.col("first") + F.col("before")).alias("before"), "first"))
    n_ranges, running = states.agg(F.count(F.lit(1)), F.max("within")).first()
    if n_ranges > MOST_RANGES:
        raise ValueError(f"{n_ranges} ranges; raise spark.sql.files.maxPartitionBytes so that there are at most {MOST_RANGES}")
    known = lines.join(F.broadcast(states.drop("first")), list(_KEY)).select("file", "start", "value", "within", "before")
    shape = "file bigint, start bigint, position bigint, opens boolean, record string"
    found = known.mapInArrow(_cut_records(False), shape).select("file", "position", "record")
    open_ = known.mapInArrow(_cut_records(True), shape)
    if running or not counted.where("odd = 1").isEmpty():
        # Pieces in order of their ranges; within one, the end of an earlier record comes before the start of the next.
        upto = Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)
        turned = open_.withColumn("turn", F.sum(F.col("opens").cast("int")).over(upto))
        joined = turned.groupBy("file", "turn").agg(
            F.max("position").alias("position"), F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"))
        found = found.union(joined.select("file", "position", F.concat_ws("\n", "parts.record")))
    header = firsts.select("file", "first")
    found = found.join(F.broadcast(header) if n_ranges <= MOST_RANGES else header, "file").where("position <> first")
    return found.select("position", F.regexp_replace("record", "\r$", "").alias("record"))
