"""Scores from a matrix product with an error bound: every answer equals, bit for bit, the one from scores in order."""

import numpy as np
import pyarrow as pa
import pytest

from pairwright.operators import cells
from pairwright.settings import RetrievalSettings

RNG = np.random.default_rng(7)


def units(n, width):
    v = RNG.normal(size=(n, width))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def grid(n, width):
    """Scores on a coarse grid: many exact ties, many scores on bin edges."""
    return (RNG.integers(-2, 3, size=(n, width)) / 4).astype(np.float32)


def copies(n, width):
    v = units(n, width)
    v[n // 3:2 * n // 3] = v[0]
    return v


def near(n, width):
    v = units(n, width)
    v[n // 4:] = v[0] + RNG.normal(size=(n - n // 4, width)).astype(np.float32) * 1e-7
    return v


def swapped(n, width):
    """The same elements in another order: scores that differ by the order of the sums alone."""
    v = units(1, width)[0]
    return np.array([RNG.permutation(v) if i % 2 else v for i in range(n)])


MAKERS = {"units": units, "grid": grid, "copies": copies, "near": near, "swapped": swapped,
          "large": lambda n, w: units(n, w) * np.float32(1e15), "small": lambda n, w: units(n, w) * np.float32(1e-22),
          "zero": lambda n, w: np.zeros((n, w), np.float32),
          "mixed": lambda n, w: units(n, w) * (10.0 ** RNG.integers(-6, 3, size=(n, 1))).astype(np.float32)}


def units_of(kind):
    return () if kind == "large" else (16, 2_048, 1 << 23)  # bins of scores beyond 2^63 have no number


def targets_for(vectors, width):
    return np.concatenate([vectors[:3], units(9, width), np.ones((1, width), np.float32), np.zeros((1, width), np.float32)])


@pytest.mark.parametrize("kind", MAKERS)
@pytest.mark.parametrize("n", [1, 2, 3, 40, 1_001, 3_000])
@pytest.mark.parametrize("estimate", [np.float32, np.float64])
@pytest.mark.parametrize("few", [1, 16])
def test_every_answer_is_that_of_scores_in_order(monkeypatch, kind, n, few, estimate):
    monkeypatch.setattr(cells, "_FEW", few)
    monkeypatch.setattr(cells, "_SLAB", 7_000)
    for width in (1, 5, 64):
        vectors = MAKERS[kind](n, width)
        targets, columns = targets_for(vectors, width), np.ascontiguousarray(vectors.T)
        plain = cells.Slab(np.vstack([part for _, part in cells._scores(targets, columns)]))
        slabs = list(cells._slabs(targets, columns, estimate))
        assert sum(len(s) for _, s in slabs) == len(targets)
        assert all(isinstance(s, cells.BoundedSlab) for _, s in slabs)
        for ask in (
            lambda s, rows: s.best(),
            lambda s, rows: s.mad(),
            lambda s, rows: s.reaching(plain.best()[rows] - plain.mad()[rows]),
            lambda s, rows: s.reaching(plain.scores[rows, n // 2]),
            *[lambda s, rows, u=u: s.bins(u) for u in units_of(kind)],
            *[lambda s, rows, k=k: np.concatenate(s.top(np.full(len(s), k))) for k in (0, 1, 5, 100)],
            *[lambda s, rows, u=u: np.concatenate([np.sort(x) for x in s.within(
                [sorted({int(b[0]), int(b[-1]), int(b[0]) + 1}) for b in plain.bins(u)[rows]], u)]) for u in units_of(kind)],
        ):
            for row, _ in slabs:
                fresh = next(s for r, s in cells._slabs(targets, columns, estimate) if r == row)
                rows = np.arange(row, row + len(fresh))
                want = ask(cells.Slab(plain.scores[rows]), rows)
                assert np.array_equal(ask(fresh, rows), want)


def test_few_scores_are_computed_by_themselves():
    vectors = units(20_000, 64)
    targets = units(20, 64)
    (_, slab), = cells._slabs(targets, np.ascontiguousarray(vectors.T), np.float32)
    slab.best(), slab.reaching(slab.best() - 3 * slab.mad()), slab.top(np.full(20, 100))
    assert slab.full is None and slab.left > slab.estimates.size // 20  # of a sixteenth
    (_, slab), = cells._slabs(targets, np.ascontiguousarray(vectors.T), np.float64)
    left = slab.left
    slab.best(), slab.bins(2_048)
    assert slab.full is None and slab.left > left - 100


def test_beyond_single_precision_and_doubles():
    big = np.full((3, 4), 3e30, np.float32)
    (_, slab), = cells._slabs(big, np.ascontiguousarray(big.T), np.float32)
    assert type(slab) is cells.Slab and np.isfinite(slab.scores).all()
    (_, slab), = cells._slabs(big.astype(float), np.ascontiguousarray(big.T.astype(float)), np.float32)
    assert type(slab) is cells.Slab
    with pytest.raises(ValueError):
        list(cells._slabs(big * np.float32("inf"), np.ascontiguousarray(big.T), np.float32))


@pytest.mark.parametrize("pairs", [True, False])
@pytest.mark.parametrize("kind", MAKERS)
def test_whole_groups(monkeypatch, kind, pairs):
    vectors = MAKERS[kind](900, 16)
    candidates = pa.table({"cand_id": np.arange(900), "group": [f"g{i % 2}" for i in range(900)],
                           "embedding": pa.array(list(vectors), pa.list_(pa.float32()))})
    targets = pa.table({"target_id": np.arange(12), "embedding": pa.array(list(vectors[:12]), pa.list_(pa.float32()))})
    types = {"target_id": pa.int64(), "group": pa.string(), "n_pool": pa.int64(), "n_above": pa.int64(), "max_in_group": pa.float64(),
             "delta": pa.float64(), "threshold": pa.float64()}
    if pairs:
        types |= {"cand_id": pa.int64(), "score": pa.float64(), "rank_in_group": pa.int64()}
    run = cells.whole_groups(RetrievalSettings(min_candidates=3, max_candidates=20), types, pairs)
    got = run(candidates, targets)
    monkeypatch.setattr(cells, "_WIDEST", 0)
    assert got.equals(run(candidates, targets))


def table_of(vectors, **columns):
    return pa.table(columns | {"embedding": pa.array(list(vectors), pa.list_(pa.float32()))})


STATS = {"target_id": pa.int64(), "group": pa.string(), "n_pool": pa.int64(), "n_above": pa.int64(), "max_in_group": pa.float64(),
         "delta": pa.float64(), "threshold": pa.float64()}


@pytest.mark.parametrize("kind", ["units", "copies", "near", "grid", "zero"])
def test_deviation_needs_no_score_in_order(monkeypatch, kind):
    """The deviation of a large group comes from the moments of its vectors; the scores themselves are estimates."""
    vectors, given = MAKERS[kind](3_000, 16), units(40, 16)
    scores = given.astype(float) @ vectors.T.astype(float)

    def no(*_):
        raise AssertionError("all scores were summed")

    monkeypatch.setattr(cells, "_sums", no)
    run = cells.whole_groups(RetrievalSettings(spread="sd", scale=1.5), STATS, False)
    got = run(table_of(vectors, cand_id=np.arange(3_000), group=["g"] * 3_000), table_of(given, target_id=np.arange(40)))
    assert np.allclose(got.column("delta").to_numpy(), 1.5 * scores.std(axis=1), rtol=0, atol=1e-7 if kind == "near" else 1e-12)
    assert np.allclose(got.column("max_in_group").to_numpy(), scores.max(axis=1), rtol=0, atol=1e-12)
    reached = (scores >= got.column("threshold").to_numpy()[:, None] - 1e-12).sum(axis=1)
    if kind in ("units", "copies"):
        assert got.column("n_above").to_pylist() == reached.tolist()


@pytest.mark.parametrize("kind", MAKERS)
def test_moments_are_exact_and_add_up(kind):
    columns = np.ascontiguousarray(MAKERS[kind](90, 5).T)
    columns[0, 3], columns[1, 7] = 100, -6_000
    whole = cells._moments(columns)
    parts = [cells._moments(np.ascontiguousarray(columns[:, part])) for part in (slice(0, 1), slice(1, 50), slice(50, 90))]
    assert [list(x) for x in whole] == [list(sum(x)) for x in zip(*parts, strict=True)]
    steps = [[round(float(x) * 2**40) for x in line] for line in columns]
    assert list(whole[0]) == [sum(line) for line in steps]
    assert list(whole[1]) == [sum(a * b for a, b in zip(steps[i], steps[k], strict=True)) for i in range(5) for k in range(i, 5)]


def test_vectors_far_from_unit_norm_have_no_deviation():
    for n in (20, 600):
        far = table_of(3 * units(n, 4), cand_id=np.arange(n), group=["g"] * n)
        for run in (cells.whole_groups(RetrievalSettings(spread="sd"), STATS, False),
                    cells.profile(RetrievalSettings(spread="sd"), {"target_id": pa.int64(), "group": pa.string()})):
            with pytest.raises(ValueError, match="unit norm"):
                run(far, table_of(4 * units(300, 4), target_id=np.arange(300)))


def test_selection_by_deviation_sums_few_scores_in_order(monkeypatch):
    """Only the covariance and the best pairs are summed in order, and a sum down the rows has their order."""
    vectors, given, widths, plain = units(4_000, 16), units(30, 16), [], cells._scores
    monkeypatch.setattr(cells, "_scores", lambda targets, columns: widths.append(columns.shape[1]) or plain(targets, columns))
    run = cells.whole_groups(RetrievalSettings(spread="sd", min_candidates=3, max_candidates=20), STATS | {
        "cand_id": pa.int64(), "score": pa.float64(), "rank_in_group": pa.int64()}, True)
    got = run(table_of(vectors, cand_id=np.arange(4_000), group=["g"] * 4_000), table_of(given, target_id=np.arange(30)))
    assert set(widths) == {16}
    scores = np.vstack([part for _, part in plain(given, np.ascontiguousarray(vectors.T))])
    for t in range(30):
        mine = got.filter(pa.compute.equal(got.column("target_id"), t))
        order = np.argsort(-scores[t], kind="stable")[:mine.num_rows]
        assert mine.num_rows == 20 and mine.column("cand_id").to_pylist() == order.tolist()
        assert mine.column("score").to_pylist() == scores[t][order].tolist()
    for n in (1, 2, 3, 1_024):
        products = RNG.normal(size=(64, n))
        assert np.array_equal(cells._down_the_rows(products), np.add.accumulate(products, axis=0)[-1])
