"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are dealt to the cells of pivots that lie far apart, large cells to shells by the distance from their pivot, and
large shells to blocks; a block is what one tree indexes. A query first searches the shell it lies in, which gives it a
kth score; then it goes to the other shells, each with a radius of its own, that can hold a score as high. Within a block,
the tree of the data and trees of batches of queries are descended together: a pair of nodes is dropped when the best inner
product that their centres and covering radii allow is below the worst kth score of the queries in the node.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from pairwright.llm.common import cut, plain

#: Pivots: one for each BLOCK rows within these numbers, chosen among SPARE times as many rows; shells of a cell.
PIVOTS, MOST_PIVOTS, SPARE, SHELLS = 16, 1024, 4, 16
#: Rows against which a first kth score of each query is found. Like the pivots, a bounded sample by a hash of the vector.
SAMPLE = 2048
#: Vectors of a block, queries of a tree, points of a leaf, children of a node.
BLOCK, BATCH, LEAF, CHILDREN = 4096, 1024, 192, 16
_EXACT = float(1 << 53)
_LONG = 1 << 63


def scaled(vectors: DataFrame, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): components as floor(scale * x). Vectors that are null or hold null or non-finite components go, and rows without id."""
    v = F.transform(plain(vector), lambda x: x.cast("double"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    read = vectors.select(plain(id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    return read.where(~F.coalesce(odd, F.lit(False))).select(
        "vec_id", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of a list column, with zeros behind the shorter ones."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(width, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def widen(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, exactly; beyond the range of a long, its nearest end."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, a.shape[1])
    if most < _EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -_LONG, _LONG - 1).astype(np.int64)


@dataclass
class Node:
    """A node covers the points from `start` to `end` of the tree's order within `radius` of `center`; a leaf has no children."""

    start: int
    end: int
    center: np.ndarray
    norm: float
    radius: float
    children: list[Node]


def cover_tree(x: np.ndarray) -> tuple[np.ndarray, Node]:
    """(order of the points, root). Centres of a level lie more than its scale apart and the scale halves below; where a
    level would have more than CHILDREN centres, what is left joins the nearest. A node's radius is the farthest of its
    points, whatever the scale."""
    order: list[np.ndarray] = []

    def build(points: np.ndarray, scale: float, start: int) -> Node:
        own = x[points]
        center = own[0]
        away = np.sqrt(((own - center) ** 2).sum(axis=1))
        node = Node(start, start + len(points), center, float(np.sqrt((center**2).sum())), float(away.max()), [])
        if len(points) <= LEAF or node.radius == 0:
            order.append(points)
            return node
        scale = min(scale, node.radius) / 2
        while True:
            nearest, place, centers = away.copy(), np.zeros(len(points), np.int64), 1
            while centers < CHILDREN and nearest[far := int(nearest.argmax())] > scale:
                to = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
                closer = to < nearest
                nearest[closer], place[closer] = to[closer], centers
                place[far], nearest[far] = centers, 0.0
                centers += 1
            if centers > 1:
                break
            scale /= 2
        for k in range(centers):
            mine = np.flatnonzero(place == k)
            if len(mine):
                node.children.append(build(points[mine[np.argsort(nearest[mine], kind="stable")]], scale, start))
                start += len(mine)
        return node

    root = build(np.arange(len(x)), np.inf, 0)
    return np.concatenate(order), root


class Block:
    """The data of one block, and the search of batches of queries in it."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.given = (ids, vectors)
        self.width = -1

    def _index(self, width: int) -> None:
        if width != self.width:
            ids, vectors = self.given
            wide = widen(vectors, width)
            order, self.root = cover_tree(wide.astype(float))
            self.width, self.ids, self.vectors = width, ids[order], wide[order]
            self.floats = self.vectors.astype(float)
            self.most = float(np.abs(self.floats).max(initial=0))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id of the vector, score): all that can be among a query's k best, given that its kth best
        score of all vectors is at least `least`."""
        self._index(max(queries.shape[1], self.given[1].shape[1]))
        queries = widen(queries, self.width)
        order, root = cover_tree(queries.astype(float))
        query_ids, queries, kth = query_ids[order], queries[order], least[order].astype(float)
        floats = queries.astype(float)
        exact = float(np.abs(floats).max(initial=0)) * self.most * max(1, self.width) < _EXACT
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def bound(q: Node, d: Node) -> float:
            best = float(q.center @ d.center) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
            return max(best + 1 + 1e-9 * (q.norm + q.radius) * (d.norm + d.radius), float(-_LONG))

        todo = [(bound(root, self.root), root, self.root)]
        while todo:
            best, q, d = todo.pop()
            if best < kth[q.start:q.end].min():
                continue
            if d.children and (not q.children or d.radius >= q.radius):
                todo.extend(sorted(((bound(q, c), q, c) for c in d.children), key=lambda t: t[0]))
            elif q.children:
                todo.extend((bound(c, d), c, d) for c in q.children)
            else:
                a, b = slice(q.start, q.end), slice(d.start, d.end)
                scores = floats[a] @ self.floats[b].T if exact else products(queries[a], self.vectors[b])
                own = query_ids[a][:, None] == self.ids[b][None, :]
                rows, columns = np.nonzero((scores >= kth[a][:, None]) & ~own)
                found.append((rows + q.start, columns + d.start, scores[rows, columns].astype(np.int64)))
                if scores.shape[1] > k and len(rows):
                    others = np.where(own, scores.min(), scores)
                    raised = np.maximum(kth[a], np.partition(others, -k, axis=1)[:, -k].astype(float))
                    kth[a] = np.where((~own).sum(axis=1) >= k, raised, kth[a])  # a query may have several own rows
        none = np.empty(0, np.int64)
        row, column, score = (np.concatenate([f[n] for f in found]) if found else none for n in range(3))
        keep = score >= kth[row]
        row, column, score = row[keep], column[keep], score[keep]
        ranked = np.lexsort((self.ids[column], -np.maximum(score, 1 - _LONG), row))
        row, column, score = row[ranked], column[ranked], score[ranked]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        return order[row[keep]], self.ids[column[keep]], score[keep]


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """At most `count` different points: the first one, then always the farthest from those taken."""
    x = points.astype(float)
    taken, nearest = [0], np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(taken) < count and nearest[far := int(nearest.argmax())] > 0:
        taken.append(far)
        nearest = np.minimum(nearest, np.sqrt(((x - x[far]) ** 2).sum(axis=1)))
    return points[taken]


def _cells(pivots: np.ndarray):
    """Adds the nearest pivot and the distance from it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = matrix(part.column(1), pivots.shape[1]).astype(float)
                p = widen(pivots, x.shape[1]).astype(float)
                cell = ((p**2).sum(1)[None, :] - 2 * x @ p.T).argmin(axis=1)
                away = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int64)), pa.array(away)], names=["vec_id", "v", "cell", "away"])

    return run


def _reach(pivots: np.ndarray, shells: np.ndarray, radii: np.ndarray):
    """Adds the shells, but a query's own, that can hold a score as high as the query still needs."""
    of = shells // SHELLS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                q = matrix(part.column(1), pivots.shape[1]).astype(float)
                p = widen(pivots, q.shape[1]).astype(float)
                own, least = (part.column(c).to_numpy(zero_copy_only=False) for c in (2, 3))
                long, far = np.sqrt((q**2).sum(axis=1))[:, None], np.sqrt((p**2).sum(axis=1))[of]
                best = (q @ p.T)[:, of] + long * radii + 1e-9 * long * (far + radii) + 2
                to = (np.maximum(best, float(-_LONG)) >= least[:, None]) & (own[:, None] != shells[None, :])
                ends = np.concatenate([[0], np.cumsum(to.sum(axis=1))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(shells[np.nonzero(to)[1]]))],
                                                 names=["vec_id", "v", "shell", "least", "key", "to"])

    return run


def _first_kth(sample_ids: np.ndarray, sample: np.ndarray, k: int):
    """Adds the kth best score of each query in the sample, without its own row: no better than its kth best of all."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                part = batch.slice(start, BATCH)
                q = matrix(part.column(1), sample.shape[1])
                scores = products(q, widen(sample, q.shape[1]))
                ids = part.column(0).to_numpy(zero_copy_only=False)
                scores[ids[:, None] == sample_ids[None, :]] = np.iinfo(np.int64).min
                least = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(q), np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(least)], names=["vec_id", "v", "cell", "away", "least"])

    return run


def _search(k: int):
    names = ["query_id", "query_key", "vec_id", "score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by block, its data before its queries."""
        key, block = None, None
        held: list[pa.RecordBatch] = []

        def index() -> Block | None:
            if not held:
                return None
            width = max(matrix(h.column(4)).shape[1] for h in held)
            ids = np.concatenate([h.column(3).to_numpy(zero_copy_only=False) for h in held])
            return Block(ids, np.concatenate([matrix(h.column(4), width) for h in held]))

        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            edges = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(kind) != 0)) + 1).tolist(), batch.num_rows]
            for s, e in zip(edges, edges[1:], strict=False):
                if (int(cell[s]), int(part[s])) != key:
                    key, block, held = (int(cell[s]), int(part[s])), None, []
                if kind[s] == 0:
                    held.append(batch.slice(s, e - s))
                    continue
                if block is None:
                    block, held = index(), []
                if block is None:
                    continue
                for low in range(s, e, BATCH):
                    q = batch.slice(low, min(BATCH, e - low))
                    ids = q.column(3).to_numpy(zero_copy_only=False)
                    row, near, score = block.search(ids, matrix(q.column(4)), q.column(5).to_numpy(zero_copy_only=False), k)
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays([q.column(3).take(at), q.column(6).take(at), pa.array(near), pa.array(score)], names=names)

    return run


def found_and_sent(vectors: DataFrame, k: int, every: int, scale: float, id: str, vector: str) -> tuple[DataFrame, DataFrame] | None:
    """What the searches find for the queries (query_id, query_key, vec_id, score), a superset of each query's k best, and
    the queries with the shells `to` which they are sent after their own. None without a vector."""
    same = Window.partitionBy("v").orderBy("vec_id")
    given = cut(scaled(vectors, scale, id, vector))
    repeats = given.groupBy("v", "vec_id").agg(F.count(F.lit(1)).alias("rows"))
    wanted_ids = repeats.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    copies = F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(k)).cast("int")))
    rows = wanted_ids.select("vec_id", "v", copies.alias("n")).drop("n")
    count = min(MOST_PIVOTS, max(PIVOTS, given.count() // BLOCK))
    by_hash = given.select("v", F.xxhash64("v").alias("h")).distinct().orderBy("h", "v").limit(SPARE * count).collect()
    if not by_hash:
        return None
    spread = given.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(SAMPLE).collect()
    width = max(len(r["v"]) for r in [*by_hash, *spread])
    padded = lambda found: np.array([[*r["v"], *[0] * (width - len(r["v"]))] for r in found], np.int64).reshape(len(found), width)
    pivots, sample = far_apart(padded(by_hash), count), padded(spread)
    sample_ids = np.array([r["vec_id"] for r in spread], np.int64)
    spark = given.sparkSession

    in_cell = "vec_id bigint, v array<bigint>, cell bigint, away double"
    data = cut(rows.mapInArrow(_cells(pivots), in_cell))
    asked = given.where(F.col("vec_id") % every == 0).distinct()
    queries = cut(asked.mapInArrow(_cells(pivots), in_cell).mapInArrow(_first_kth(sample_ids, sample, k), in_cell + ", least bigint"))
    steps = [n / SHELLS for n in range(1, SHELLS)]
    sizes = data.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("away", steps, 1000).alias("at")).collect()  # at most MOST_PIVOTS
    edges = dict.fromkeys(range(len(pivots)), [])
    for r in sizes:
        shells = min(SHELLS, -(-r["n"] // BLOCK))
        edges[r["cell"]] = [r["at"][n * SHELLS // shells - 1] for n in range(1, shells)]
    cuts = F.broadcast(spark.createDataFrame(list(edges.items()), "cell bigint, edges array<double>"))
    shell = F.col("cell") * SHELLS + F.size(F.filter("edges", lambda e: e < F.col("away")))
    data = data.join(cuts, "cell").select("vec_id", "v", "away", shell.alias("shell"))
    queries = queries.join(cuts, "cell").select("vec_id", "v", shell.alias("shell"), "least", F.xxhash64("v").alias("key"))
    held = sorted(tuple(r) for r in data.groupBy("shell").agg(F.count(F.lit(1)), F.max("away")).collect())  # at most SHELLS for each pivot
    parts = F.broadcast(spark.createDataFrame([(s, -(-n // BLOCK)) for s, n, _ in held], "shell bigint, parts bigint"))

    none = F.lit(None).cast("bigint")
    blocks = data.join(parts, "shell").select(
        "shell", F.pmod(F.xxhash64("v", "vec_id"), "parts").alias("part"), F.lit(0).alias("kind"), "vec_id", "v", none.alias("least"), none.alias("key"))
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))  # the work is in the pairs, not in the bytes

    def search(sent: DataFrame) -> DataFrame:
        copied = sent.join(parts, "shell").select(
            "shell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "vec_id", "v", "least", "key")
        dealt = blocks.union(copied).repartition(tasks, "shell", "part").sortWithinPartitions("shell", "part", "kind")
        return dealt.mapInArrow(_search(k), "query_id bigint, query_key bigint, vec_id bigint, score bigint")

    near = cut(search(queries))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc())
    kth = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("query_key").alias("key"), F.col("score").alias("kth"))
    needing = queries.join(kth, ["vec_id", "key"], "left").select(
        "vec_id", "v", "shell", F.greatest("least", "kth").alias("least"), "key")  # greatest skips nulls
    reach = _reach(pivots, np.array([s for s, _, _ in held], np.int64), np.array([r for _, _, r in held], float))
    sent = cut(needing.mapInArrow(reach, "vec_id bigint, v array<bigint>, shell bigint, least bigint, key bigint, to array<bigint>"))
    return near.union(search(sent.withColumn("shell", F.explode("to")).drop("to"))), sent


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the highest integer inner product for each query, ties to the
    smaller id. Queries are the vectors whose id is divisible by `every`; candidates all vectors with another id.

    Vectors that are null, or hold null or non-finite components, and rows without id take no part. Shorter vectors have
    zeros behind; a vector without components is zero. Repeated rows are candidates each; equal queries count once. Of
    equal vectors the k + 1 smallest ids are indexed, each with at most k rows, which are all that any query can ask for
    (it leaves out all rows of its own id), so a vector that a third of all rows hold is no hot block. Fewer than k others give fewer rows; an empty table gives an empty table.
    Scores beyond a long are its nearest end. Pivots and shells decide what is searched, never what is found. Results of blocks, at most k each and not below a kth score that the query
    has already, are ranked by a window over the query.
    """
    got = found_and_sent(vectors, k, every, scale, id, vector)
    if got is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    ranked = got[0].withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
