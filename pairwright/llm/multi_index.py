"""Approximate nearest neighbours by inner product: binary codes in a multi-index, then the vectors themselves.

1. Vectors get codes of `bits` signs after learned rotations (iterative quantization on a bounded sample: turns of signs
   and of the rotation nearest to them). Norms enter by one more component that makes all vectors equally long, so the
   angle to a query orders vectors as their inner product does.
2. A code is split into bytes, and each byte is an index of its own: the codes of each of its 256 values. With `m` bytes,
   shell `t` is the distance `t // m` in byte `t % m`. Two codes within Hamming distance `r` share one of the shells 0 to
   `r` (else byte i would differ in more than the shells allow, and the sum would exceed r), so probing these shells finds
   every code within `r`.
3. A query probes its shells in order. What they find is checked by its full distance, and its inner product is taken.
   The radius of a query starts from its kth best score in the sample and shrinks as better ones are found.

Codes are dealt over blocks of about BLOCK rows, one task each, and queries, a stated set, meet every block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairwright.llm.common import cut, plain

#: Vectors that the rotations are learned from and that bound the radius; rows of a block; queries probed at once.
SAMPLE = 4_096
BLOCK = 8_192
BATCH = 512
BITS = 256
#: Shells probed before the radius is looked at again, and the spread of bits (in standard deviations) a radius allows for.
STEP = 16
SLACK = 1.5
_APART = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])
#: Byte values in order of their distance from each value, and where each distance begins.
_NEAR = np.argsort(_APART, axis=1, kind="stable")
_FROM = np.array([0, 1, 9, 37, 93, 163, 219, 247, 255, 256])


@dataclass(frozen=True)
class Codes:
    """The learned rotations: `turn` has a column for each bit, `longest` is the norm that all vectors are brought to."""

    turn: np.ndarray
    longest: float

    def of(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """Codes as bytes. Queries have nothing in the last component, so that it does not count for them."""
        x = vectors / self.longest if self.longest else vectors
        rest = np.zeros(len(x)) if queries else np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        return np.packbits(np.column_stack([x, rest]) @ self.turn > 0, axis=1)


def learn(sample: np.ndarray, bits: int, longest: float, turns: int = 20, seed: int = 11) -> Codes:
    """Rotations of the sample, one after another until there are enough columns, each brought near to its own signs."""
    x = sample / longest if longest else sample
    x = np.column_stack([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))])
    rng, width = np.random.default_rng(seed), x.shape[1]
    found: list[np.ndarray] = []
    while sum(r.shape[1] for r in found) < bits:
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(turns if len(x) >= width else 0):
            u, _, v = np.linalg.svd(x.T @ np.sign(x @ turn))
            turn = u @ v
        found.append(turn)
    return Codes(np.concatenate(found, axis=1)[:, :bits], longest)


def radius_of(least: np.ndarray, norms: np.ndarray, longest: float, bits: int) -> np.ndarray:
    """The Hamming radius that vectors with at least this score lie in, but for the spread of the bits. All bits without a score."""
    with np.errstate(all="ignore"):
        share = np.arccos(np.clip(least / (norms * longest), -1, 1)) / np.pi
        wide = np.ceil(bits * share + SLACK * np.sqrt(bits * share * (1 - share)))
    return np.where(np.isfinite(least) & np.isfinite(wide), np.minimum(wide, bits), bits).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray, row_a: np.ndarray | slice = slice(None), row_b: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Inner products of columns in double, added in order of the components, so that equal vectors have equal scores."""
    out = 0.0
    with np.errstate(all="ignore"):
        for x, y in zip(a, b, strict=True):
            out = out + x[row_a] * y[row_b]
    return np.where(np.isnan(out), -np.inf, out)


def distances(a: np.ndarray, b: np.ndarray, row_a: np.ndarray, row_b: np.ndarray) -> np.ndarray:
    """Hamming distances of columns of words."""
    return sum(np.bitwise_count(x[row_a] ^ y[row_b]).astype(np.int16) for x, y in zip(a, b, strict=True))


class Block:
    """The index of one block: for each byte of the codes and each of its values, the rows as a bitmap."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.words = ids, np.ascontiguousarray(vectors.T), np.ascontiguousarray(codes.view(np.uint64).T)
        self.maps = [np.packbits(np.arange(256, dtype=np.uint8)[:, None] == c[None, :], axis=1) for c in codes.T]

    def probe(self, codes: np.ndarray, asked: np.ndarray, shell: int, hit: np.ndarray) -> None:
        """Adds to `hit` (a bitmap for each query) the rows that the shell of the queries `asked` holds."""
        apart, byte = divmod(shell, codes.shape[1])
        values, own = np.unique(codes[asked, byte], return_inverse=True)
        near = _NEAR[values, _FROM[apart]:_FROM[apart + 1]]
        found = self.maps[byte][near[:, 0]]
        for k in range(1, near.shape[1]):
            found |= self.maps[byte][near[:, k]]
        hit[asked] |= found[own]

    def search(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, radius: np.ndarray, k: int, longest: float
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best found for each query, without rows of its own id, ties to the smaller id."""
        bits, n = 8 * codes.shape[1], len(self.ids)
        words, vectors = np.ascontiguousarray(codes.view(np.uint64).T), np.ascontiguousarray(vectors.T)
        norms, radius = np.sqrt(products(vectors, vectors)), radius.copy()
        seen = np.packbits(ids[:, None] == self.ids[None, :], axis=1)
        best = np.full((len(ids), k), -np.inf)
        row_of = np.full((len(ids), k), n)
        id_of = np.append(self.ids, np.iinfo(np.int64).max)
        shell = 0
        while shell <= min(bits, int(radius.max(initial=-1))):
            hit = np.zeros_like(seen)
            for t in range(shell, min(shell + STEP, bits + 1)):
                if t == bits:  # the one code that no shell holds is the complement of the query's
                    hit[radius >= t] = 255
                elif len(asked := np.flatnonzero(radius >= t)):
                    self.probe(codes, asked, t, hit)
            shell += STEP
            hit &= ~seen
            seen |= hit
            q, row = np.nonzero(np.unpackbits(hit, axis=1, count=n))
            if not len(q):
                continue
            near = distances(words, self.words, q, row) <= radius[q]
            q, row = q[near], row[near]
            if not len(q):
                continue
            score = products(vectors, self.vectors, q, row)
            above = score >= best[q, k - 1]  # the kth so far, or nothing
            q, row, score = q[above], row[above], score[above]
            order = np.lexsort((self.ids[row], -score, q))
            q, row, score = q[order], row[order], score[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            q, row, score, place = (x[place < k] for x in (q, row, score, place))
            more, more_row = np.full_like(best, -np.inf), np.full_like(row_of, n)
            more[q, place], more_row[q, place] = score, row
            best, row_of = np.concatenate([best, more], axis=1), np.concatenate([row_of, more_row], axis=1)
            turn = np.lexsort((id_of[row_of], -best, row_of == n), axis=1)[:, :k]
            best, row_of = np.take_along_axis(best, turn, 1), np.take_along_axis(row_of, turn, 1)
            full = row_of[:, k - 1] < n
            radius = np.where(full, np.minimum(radius, radius_of(best[:, k - 1], norms, longest, bits)), radius)
        q, place = np.nonzero(row_of < n)
        return q, row_of[q, place], best[q, place]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of doubles, zeros behind the shorter ones."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def usable(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """(vec_id, v, length): rows with an id whose vector is not null or zero and holds no null or non-finite component."""
    v = F.col("v")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    largest = F.array_max(F.transform(v, F.abs))
    squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / F.col("largest")) ** 2)
    given = vectors.select(plain(id).cast("long").alias("vec_id"), plain(vector).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    given = given.where(~F.exists(v, bad)).withColumn("largest", largest).where("largest > 0")
    return given.select("vec_id", F.transform(v, lambda x: x + F.lit(0.0)).alias("v"), F.least(F.col("largest") * F.sqrt(squares), F.lit(1.7e308)).alias("length"))


def _coded(codes: Codes, width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                made = codes.of(matrix(part.column(1), width))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in made], pa.binary())], names=["vec_id", "v", "code"])

    return run


def _asked(codes: Codes, width: int, sample_ids: np.ndarray, sample: np.ndarray, k: int, bits: int):
    """Adds a query's code and its first radius, from its kth best score among the sample's rows of other ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                q = matrix(part.column(1), width)
                with np.errstate(all="ignore"):
                    scores = np.nan_to_num(q @ sample.T, nan=-np.inf)
                    norms = np.sqrt(products(q.T, q.T))
                scores[part.column(0).to_numpy(zero_copy_only=False)[:, None] == sample_ids[None, :]] = -np.inf
                least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), -np.inf)
                made = [c.tobytes() for c in codes.of(q, queries=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.binary()), pa.array(radius_of(least, norms, codes.longest, bits))],
                                                 names=["vec_id", "v", "code", "radius"])

    return run


def _search(width: int, k: int, longest: float):
    names = ["query_id", "query_key", "vec_id", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by block, its codes before its queries."""
        key, block = None, None
        held: list[pa.RecordBatch] = []
        codes = lambda column: np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            at, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(2))
            edges = [0, *(np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(edges, edges[1:], strict=False):
                if int(at[s]) != key:
                    key, block, held = int(at[s]), None, []
                if kind[s] == 0:
                    held.append(batch.slice(s, e - s))
                    continue
                if held:
                    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    block, held = Block(table.column(2).to_numpy(zero_copy_only=False), matrix(table.column(3), width), codes(table.column(4))), []
                if block is None:
                    continue
                for low in range(s, e, BATCH):
                    part = batch.slice(low, min(BATCH, e - low))
                    ids = part.column(2).to_numpy(zero_copy_only=False)
                    q, row, score = block.search(ids, matrix(part.column(3), width), codes(part.column(4)), part.column(5).to_numpy(zero_copy_only=False), k, longest)
                    take = pa.array(q)
                    yield pa.RecordBatch.from_arrays([part.column(2).take(take), part.column(6).take(take), pa.array(block.ids[row]), pa.array(score)], names=names)

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, bits: int = BITS, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query the k vectors found with the largest inner product, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`; candidates all rows with another id. Scores are inner products
    of the given vectors in double, added in order of their components. Vectors that are null, zero, or hold null or
    non-finite components, and rows without id take no part; shorter vectors have zeros behind. Every other row is in the
    index, but of equal vectors only the k + 1 smallest ids with k rows each, which are all that a query can ask for, so a
    vector that many rows hold is no hot block. Repeated rows are candidates each; equal queries count once. A query that
    found fewer than k (and fewer than there are) asks again with the whole radius. An empty table gives an empty table;
    further columns are ignored. What is learned and the first radius come from at most SAMPLE rows in order of a hash.
    """
    spark = vectors.sparkSession
    given = cut(usable(vectors, id, vector))
    size, longest, rows = given.agg(F.max(F.size("v")), F.max("length"), F.count(F.lit(1))).first()
    if not rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    chosen = given.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(SAMPLE).select("vec_id", "v").collect()
    sample = np.array([[*r["v"], *[0.0] * (size - len(r["v"]))] for r in chosen], float)
    sample_ids = np.array([r["vec_id"] for r in chosen], np.int64)
    codes = learn(sample, bits, longest)

    repeats = given.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    few = repeats.withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    copies = F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(k)).cast("int"))).alias("copy")
    indexed = few.select("vec_id", "v", copies).drop("copy").mapInArrow(_coded(codes, size), "vec_id bigint, v array<double>, code binary")
    asked = given.where(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    queries = cut(asked.mapInArrow(_asked(codes, size, sample_ids, sample, k, bits), "vec_id bigint, v array<double>, code binary, radius bigint"))
    blocks = -(-rows // BLOCK)
    none = F.lit(None).cast("bigint")
    index = cut(indexed.select(F.pmod(F.xxhash64("v", "vec_id"), F.lit(blocks)).alias("block"), F.lit(0).alias("kind"), "vec_id", "v", "code",
                               none.alias("radius"), none.alias("query_key")))

    def found(queries: DataFrame, radius: Column) -> DataFrame:
        every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block")
        sent = queries.select(every_block, F.lit(1).alias("kind"), "vec_id", "v", "code", radius.alias("radius"), F.xxhash64("v").alias("query_key"))
        met = index.union(sent).repartitionById(blocks, F.col("block").cast("int")).sortWithinPartitions("block", "kind")
        return cut(met.mapInArrow(_search(size, k, longest), "query_id bigint, query_key bigint, vec_id bigint, score double"))

    key = ["query_id", "query_key"]
    first = found(queries, F.col("radius"))
    reached = first.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    named = queries.withColumn("query_key", F.xxhash64("v")).withColumnRenamed("vec_id", "query_id")
    short = cut(named.join(reached, key, "left").where((F.coalesce("n", F.lit(0)) < k) & (F.col("radius") < bits)).select(
        F.col("query_id").alias("vec_id"), "v", "code", "radius", "query_key"))
    if not short.isEmpty():
        again = found(short, F.lit(bits).cast("bigint"))
        first = first.join(short.select(F.col("vec_id").alias("query_id"), "query_key"), key, "left_anti").union(again)
    best = Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id")
    return first.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
