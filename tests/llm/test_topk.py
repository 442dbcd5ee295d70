import math
import random

import numpy as np
import pytest

from pairwright.llm import topk as K


def plain_top(rows, k, every, scale=64):
    good = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in good if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k, every):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cell int, part int")
    return sorted(tuple(r) for r in K.top_k(table, k, every).collect())


@pytest.mark.parametrize("leaf", [4, 48])
def test_equals_plain_search(spark, monkeypatch, leaf):
    monkeypatch.setattr(K, "LEAF", leaf)
    rng = np.random.default_rng(leaf)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + 0.3 * rng.normal(size=8)).astype("f4").tolist()) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(50)]  # a vector that many rows hold
    assert run(spark, rows, 5, 10) == plain_top(rows, 5, 10)


def test_blocks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 64)
    monkeypatch.setattr(K, "BATCH", 16)
    monkeypatch.setattr(K, "SAMPLE", 40)
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(3)]) for i in range(500)]  # full of ties
    assert run(spark, rows, 7, 5) == plain_top(rows, 7, 5)


def test_hostile_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (None, [1.0, 1.0]), (100, []), (1, [0.5]),
            (2, [1.0, 2.0, 3.0]), (3, [-1.0, -1.0]), (120, [1.0, 2.0])]
    assert run(spark, rows, 20, 20) == plain_top(rows, 20, 20)
    assert run(spark, rows + [(1, [0.5])], 20, 20) == plain_top(rows + [(1, [0.5])], 20, 20)
    assert run(spark, [], 20, 20) == [] and run(spark, [(0, [1.0])], 20, 20) == []


def test_products_beyond_a_double():
    a = np.array([[1 << 40, 3]], np.int64)
    assert K.products(a, a)[0, 0] == (1 << 63) - 1
    b = np.array([[(1 << 30) + 1, 1]], np.int64)
    assert K.products(b, b)[0, 0] == ((1 << 30) + 1) ** 2 + 1


@pytest.mark.parametrize("repeats", [2, 6, 21])
def test_repeated_query_id_beside_equal_vectors(spark, monkeypatch, repeats):
    monkeypatch.setattr(K, "LEAF", 4)
    rows = [(0, [2.0, 1.0])] * repeats + [(i, [2.0, 1.0]) for i in range(1, 31)] + [(100 + i, [1.0, i / 64]) for i in range(40)] + [(7, [2.0, 1.0])] * 9
    assert run(spark, rows, 5, 10) == plain_top(rows, 5, 10)
    few = rows[:repeats + 3] + rows[-49:-9]  # fewer than k others are equal
    assert run(spark, few, 5, 10) == plain_top(few, 5, 10)


def test_own_rows_raise_no_bound(monkeypatch):
    monkeypatch.setattr(K, "LEAF", 6)
    ids = np.array([0, 0, 1, 2, 3, 4, *range(10, 20)])
    vectors = np.array([[9, 0]] * 6 + [[5, i] for i in range(10)])
    _, near, score = K.Block(ids, vectors).search(np.array([0]), np.array([[9, 0]]), np.array([-1 << 62]), 5)
    assert near.tolist() == [1, 2, 3, 4, 10] and score.tolist() == [81] * 4 + [45]


def test_shells_of_large_cells(spark, monkeypatch):
    """Cells above a block, cut by distance, on vectors with ties and of uneven width."""
    for name, value in (("BLOCK", 24), ("LEAF", 8), ("PIVOTS", 2), ("MOST_PIVOTS", 3), ("SAMPLE", 30)):
        monkeypatch.setattr(K, name, value)
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, 0.5, 2.0, 40.0]) for _ in range(rng.randrange(1, 5))]) for i in range(700)]
    assert run(spark, rows, 6, 5) == plain_top(rows, 6, 5)


def clustered(n, of=200, width=12):
    rng = np.random.default_rng(n)
    centers = rng.normal(size=(n // of, width))
    centers /= np.linalg.norm(centers, axis=1)[:, None]
    return [(i, (centers[i % len(centers)] + 0.01 * rng.normal(size=width)).tolist()) for i in range(n)]


def test_queries_go_where_the_bound_allows(spark, monkeypatch):
    """Copies of queries over clustered vectors grow about as the rows do, not as their square."""
    for name, value in (("BLOCK", 64), ("SAMPLE", 64)):
        monkeypatch.setattr(K, name, value)
    sent = {}
    for n in (1600, 6400):
        table = spark.createDataFrame(clustered(n), "vec_id long, embedding array<double>")
        rows = K.found_and_sent(table, 5, 5, 64.0, "vec_id", "embedding")[1].collect()
        sent[n] = sum(len(r.to) for r in rows) + len(rows)
    assert sent[6400] < sent[1600] * 4**1.5
    rows = clustered(1600)
    assert run(spark, rows, 5, 5) == plain_top([(i, np.float32(v)) for i, v in rows], 5, 5)


def test_far_apart():
    points = np.array([[0, 0], [1, 0], [10, 0], [10, 1], [0, 0]])
    assert K.far_apart(points, 3).tolist() == [[0, 0], [10, 1], [1, 0]] and len(K.far_apart(points, 9)) == 4
