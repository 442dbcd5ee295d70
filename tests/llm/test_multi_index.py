import math
import random

import numpy as np
import pytest

from pairwright.llm import multi_index as M


def dot(a, b):
    out = 0.0
    for x, y in zip(a, b, strict=False):
        out += float(x) * float(y)
    return out


def plain_top(rows, k, every):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in {(i, tuple(v)) for i, v in good if i % every == 0}:
        scores = sorted((-dot(q, v), j) for j, v in good if j != i)
        out.setdefault(i, []).extend((r + 1, j, -s) for r, (s, j) in enumerate(scores[:k]))
    return out


def run(spark, rows, k, every):
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, block int, kind int")
    out = {}
    for r in M.nearest(table, k, every).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(got, want):
    hits = [len({x[1] for x in got.get(q, [])} & {x[1] for x in w}) / len(w) for q, w in want.items() if w]
    return sum(hits) / len(hits)


def checked(rows, got, want, k):
    """Ranks, order, and scores are exact for whatever was found, and nothing is missing where there are enough rows."""
    vector = {i: v for i, v in rows}
    for q, w in want.items():
        found = got.get(q, [])
        assert [x[0] for x in found] == list(range(1, len(w) + 1))
        assert found == sorted(found, key=lambda x: (-x[2], x[1])) and all(x[2] == dot(vector[q], vector[x[1]]) for x in found)


@pytest.mark.parametrize("kind", ["clustered", "spread", "lengths"])
def test_recall_and_exact_scores(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 32))
    if kind == "clustered":
        x = rng.normal(size=(30, 32))[np.arange(1500) % 30] + 0.2 * x
    if kind == "lengths":
        x *= rng.lognormal(0, 0.5, (1500, 1))
    rows = [(i, v.astype("f4").tolist()) for i, v in enumerate(x)]
    want = plain_top(rows, 10, 20)
    got = run(spark, rows, 10, 20)
    checked(rows, got, want, 10)
    assert recall(got, want) >= 0.9


def test_table_recall(spark, sf_dir):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    want = plain_top(rows, 20, 20)
    got = run(spark, rows, 20, 20)
    checked(rows, got, want, 20)
    assert recall(got, want) >= 0.9


def test_hostile_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (None, [1.0, 1.0]), (100, []), (1, [0.5]),
            (2, [1.0, 2.0, 3.0]), (3, [-1.0, -1.0]), (120, [1.0, 2.0]), (140, [0.0, 0.0]), (4, [0.0])]
    assert run(spark, rows, 20, 20) == plain_top(rows, 20, 20)
    assert run(spark, [], 20, 20) == {} and run(spark, [(0, [1.0])], 20, 20) == {}


def test_a_vector_that_many_rows_hold(spark):
    rng = random.Random(5)
    rows = [(i, [1.0, 0.5, -0.25]) for i in range(400)] + [(1000 + i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(200)]
    rows = [(i, np.array(v, "f4").tolist()) for i, v in rows]
    got, want = run(spark, rows, 6, 20), plain_top(rows, 6, 20)
    checked(rows, got, want, 6)
    assert all(got[q] == want[q] for q in range(0, 400, 20)) and recall(got, want) >= 0.9
    twice = rows + [(1001, rows[401][1])] * 3
    assert recall(run(spark, twice, 6, 20), plain_top(twice, 6, 20)) >= 0.9


def test_shells_hold_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (400, 8), dtype=np.uint8)
    codes[:200] = codes[200] ^ (rng.random((200, 8)) < 0.2).astype(np.uint8)
    block, asked = M.Block(np.arange(400), np.zeros((400, 1)), codes), np.arange(0, 400, 10)
    apart = np.bitwise_count(codes[asked][:, None, :] ^ codes[None]).sum(axis=2)
    hit = np.zeros((len(asked), 50), np.uint8)
    for r in range(64):
        block.probe(codes[asked], np.arange(len(asked)), r, hit)
        assert np.unpackbits(hit, axis=1)[apart <= r].all()
