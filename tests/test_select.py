"""Adaptive selection against a plain NumPy recomputation, in whole and in split groups."""

import numpy as np
import pytest
from hypothesis import given, settings as hyp, strategies as st
from pyspark.sql import functions as F, types as T

from pairwright.operators.select import adaptive_select, group_statistics, select_and_rank
from pairwright.operators.grid import place_candidates, place_targets, plan_grid
from pairwright.settings import RetrievalSettings

VECTOR = T.ArrayType(T.FloatType())


def targets_df(spark, vectors):
    schema = T.StructType([T.StructField("target_id", T.LongType()), T.StructField("embedding", VECTOR)])
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], schema)


def candidates_df(spark, rows):
    schema = T.StructType([T.StructField("cand_id", T.LongType()), T.StructField("group", T.StringType()),
                           T.StructField("embedding", VECTOR)])
    return spark.createDataFrame([(i, g, [float(x) for x in v]) for i, g, v in rows], schema)


def expected(targets, rows, s):
    """(target, group) -> (stats, ids in order), from the definition."""
    out = {}
    for t, tv in enumerate(np.asarray(targets, dtype=np.float32).astype(float)):
        for g in sorted({g for _, g, _ in rows}):
            ids = np.array([i for i, gg, _ in rows if gg == g])
            vs = np.array([v for _, gg, v in rows if gg == g], dtype=np.float32).astype(float)
            order = np.argsort(ids)
            ids, vs = ids[order], vs[order]
            scores = np.zeros(len(ids))
            for k in range(vs.shape[1]):
                scores = scores + tv[k] * vs[:, k]
            if s.spread == "mad":
                spread = np.median(np.abs(scores - np.median(scores)))
            else:
                spread = np.std(scores)
            threshold = scores.max() - s.scale * spread
            above = int((scores >= threshold).sum())
            padded = max(above, min(s.min_candidates, len(ids)))
            k = min(padded, s.max_candidates)
            stats = (len(ids), above, k, int(above < s.min_candidates), int(padded > s.max_candidates))
            out[t, g] = (stats, list(ids[np.argsort(-scores, kind="stable")[:k]]))
    return out


def check(spark, targets, rows, s):
    got = {}
    found = adaptive_select(targets_df(spark, targets), candidates_df(spark, rows), s).collect()
    for r in sorted(found, key=lambda r: r.rank_in_group):
        stats = (r.n_pool, r.n_above, r.n_selected, r.min_padded, r.max_capped)
        assert got.setdefault((r.target_id, r.group), (stats, []))[0] == stats
        got[r.target_id, r.group][1].append(r.cand_id)
        assert r.rank_in_group == len(got[r.target_id, r.group][1])
    assert got == expected(targets, rows, s)


def random_rows(n, groups, width=8, seed=0):
    rng = np.random.default_rng(seed)
    vs = rng.normal(size=(n, width))
    vs /= np.linalg.norm(vs, axis=1, keepdims=True)
    return [(i, f"g{i % groups}", v) for i, v in enumerate(vs)]


@pytest.mark.parametrize("spread", ["mad", "sd"])
@pytest.mark.parametrize("cell_rows", [65_536, 13])
@pytest.mark.parametrize("bounds", [(10, 30), (5, 2)])
def test_random_vectors(spark, spread, cell_rows, bounds):
    rows = random_rows(160, 3)
    targets = [v for _, _, v in random_rows(7, 1, seed=1)]
    check(spark, targets, rows, RetrievalSettings(
        min_candidates=bounds[0], max_candidates=bounds[1], spread=spread, cell_rows=cell_rows, bins_per_unit=16,
        cell_targets=3))


@pytest.mark.parametrize("cell_rows", [65_536, 9])
def test_a_third_of_the_rows_are_copies(spark, cell_rows):
    rows = random_rows(90, 1)
    copies = [(1_000 + i, "g0", rows[5][2]) for i in range(45)]
    targets = [rows[5][2], rows[6][2], -np.asarray(rows[5][2])]
    for spread in ("mad", "sd"):
        check(spark, targets, rows + copies, RetrievalSettings(
            min_candidates=4, max_candidates=20, cell_rows=cell_rows, spread=spread))


@pytest.mark.parametrize("cell_rows", [65_536, 2])
def test_small_pools_and_equal_scores(spark, cell_rows):
    """Width-one vectors: the score is the candidate's own value."""
    rows = [(1, "one", [0.5]), (2, "two", [0.25]), (3, "two", [0.75]),
            *[(10 + i, "equal", [0.5]) for i in range(7)],
            *[(20 + i, "ties", [x]) for i, x in enumerate([1.0, 0.5, 0.5, 0.5, 0.25, -1.0])]]
    for bounds in ((3, 5), (4, 2), (0, 1)):
        check(spark, [[1.0], [-1.0]], rows, RetrievalSettings(
            min_candidates=bounds[0], max_candidates=bounds[1], cell_rows=cell_rows))


@pytest.mark.parametrize("noise", [1e-3, 1e-7, 0.0])
def test_near_copies_take_finer_bins(spark, noise):
    rng = np.random.default_rng(9)
    rows = random_rows(60, 1, width=6)
    near = [(500 + i, "g0", np.asarray(rows[3][2]) + rng.normal(size=6) * noise) for i in range(60)]
    targets = [rows[3][2], rows[4][2]]
    check(spark, targets, rows + near, RetrievalSettings(
        min_candidates=4, max_candidates=12, cell_rows=25, bins_per_unit=4, value_rows=3))


def test_one_hot_group_beside_small_ones(spark):
    rows = random_rows(60, 1) + [(100 + i, f"s{i % 6}", v) for i, _, v in random_rows(30, 1, seed=3)]
    targets = [v for _, _, v in random_rows(5, 1, seed=4)]
    check(spark, targets, rows, RetrievalSettings(min_candidates=3, max_candidates=8, cell_rows=20))


@hyp(max_examples=4, deadline=None)
@given(st.lists(st.integers(-8, 8), min_size=1, max_size=40), st.integers(1, 6), st.sampled_from([1, 4, 16]))
def test_split_groups_match_on_any_scores(spark, values, cell_rows, bins):
    rows = [(i, "g", [v / 8]) for i, v in enumerate(values)]
    check(spark, [[1.0]], rows, RetrievalSettings(
        min_candidates=2, max_candidates=6, cell_rows=cell_rows, bins_per_unit=bins, value_rows=5))


def test_empty_inputs_give_typed_empty_results(spark):
    s, rows = RetrievalSettings(), random_rows(10, 2)
    for t, c in (([], rows), ([rows[0][2]], []), ([], [])):
        df = select_and_rank(targets_df(spark, t), candidates_df(spark, c), s)
        assert df.count() == 0 and dict(df.dtypes)["target_rank"] == "bigint"
        assert group_statistics(targets_df(spark, t), candidates_df(spark, c), s).count() == 0


def test_ranks_over_groups(spark):
    rows = random_rows(120, 4)
    targets = [v for _, _, v in random_rows(6, 1, seed=2)]
    plain = RetrievalSettings(min_candidates=3, max_candidates=9)
    spread = RetrievalSettings(min_candidates=3, max_candidates=9, window_rows=1)
    for s in (plain, spread):
        found = select_and_rank(targets_df(spark, targets), candidates_df(spark, rows), s).collect()
        for t in range(6):
            mine = sorted((r for r in found if r.target_id == t), key=lambda r: r.target_rank)
            assert [r.target_rank for r in mine] == list(range(1, len(mine) + 1))
            assert mine == sorted(mine, key=lambda r: (-r.score, r.group, r.rank_in_group))
            assert {r.max_for_target for r in mine} == {max(r.score for r in mine)}


def test_unselected_scores_below_threshold(spark):
    rows = random_rows(200, 2)
    found = adaptive_select(targets_df(spark, [rows[0][2]]), candidates_df(spark, rows),
                            RetrievalSettings(min_candidates=5, max_candidates=50)).collect()
    assert all(r.score >= r.threshold for r in found if not r.min_padded)


def test_bad_settings_and_vectors(spark):
    with pytest.raises(ValueError):
        RetrievalSettings(spread="iqr")
    with pytest.raises(ValueError):
        RetrievalSettings(bins_per_unit=1000)
    with pytest.raises(Exception, match="one common length"):
        adaptive_select(targets_df(spark, [[1.0, 0.0]]),
                        candidates_df(spark, [(1, "g", [1.0, 0.0]), (2, "g", [1.0])]), RetrievalSettings()).collect()


def test_deviation_is_the_same_in_whole_and_split_groups(spark):
    rng = np.random.default_rng(12)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype("f4").tolist()
    targets = spark.createDataFrame([*enumerate(unit(rng.normal(size=(60, 8))))], "target_id long, embedding array<float>")
    vectors = unit(rng.normal(size=(900, 8)))
    candidates = spark.createDataFrame([(i, "g", v) for i, v in enumerate(vectors)], "cand_id long, group string, embedding array<float>")
    found = [
        {r.target_id: (r.threshold, r.delta) for r in group_statistics(targets, candidates, RetrievalSettings(spread="sd", cell_rows=rows)).collect()}
        for rows in (10_000, 300, 70)
    ]
    assert found[0] == found[1] == found[2] and len(found[0]) == 60


def test_many_small_groups_share_bounded_cells(spark):
    settings = RetrievalSettings(cell_rows=4_000, cell_output=1_000_000)
    targets = spark.range(500).select(F.col("id").alias("target_id"), F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("embedding"))
    candidates = spark.range(100_000).select(F.col("id").alias("cand_id"), (F.col("id") % 10_000).cast("string").alias("group"), F.array(
        F.lit(0.0), F.lit(1.0)).cast("array<float>").alias("embedding"))
    grid = plan_grid(targets, candidates, settings)
    placed = place_candidates(candidates, grid, settings, hot=False)
    cells = {(r.part, r.chunk): r["count"] for r in placed.groupBy("part", "chunk").count().collect()}
    per_chunk = {r.chunk: r["count"] for r in place_targets(targets, grid, hot=False).where("part = 0").groupBy("chunk").count().collect()}
    assert {part for part, _ in cells} == set(range(grid.parts)) and grid.parts * grid.chunks >= 3 * grid.width
    assert max(n * per_chunk.get(chunk, 0) for (_, chunk), n in cells.items()) <= 2 * settings.cell_output
    assert placed.select("group", "part").distinct().groupBy("group").count().where("count > 1").isEmpty()


def test_last_pass_limits_within_groups(spark):
    candidates = spark.range(400).select(F.col("id").alias("cand_id"), F.lit("g").alias("group"), F.array(
        F.rand(1), F.rand(2)).cast("array<float>").alias("embedding"))
    targets = spark.range(3).select(F.col("id").alias("target_id"), F.array(F.lit(0.5), F.lit(0.5)).cast("array<float>").alias("embedding"))
    found = adaptive_select(targets, candidates, RetrievalSettings(cell_rows=100))
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_cells_are_numbered_alike_in_one_task_and_by_ranges(spark, monkeypatch):
    from pairwright.operators import grid
    from pairwright.settings import RetrievalSettings

    settings = RetrievalSettings(cell_rows=16)
    rows = spark.range(20_000).select(F.col("id").alias("cand_id"), F.when(F.col("id") < 3000, F.concat(F.lit("hot"), F.col("id") % 3)).otherwise(
        F.concat(F.lit("g"), F.col("id") % 5000)).alias("group"), F.array(F.lit(1.0)).alias("embedding"))
    targets = spark.range(5).select(F.col("id").alias("target_id"), F.array(F.lit(1.0)).alias("embedding"))
    found = []
    for limit in (100_000, 0):
        monkeypatch.setattr(grid, "_GROUPS_IN_A_TASK", limit)
        made = grid.plan_grid(targets, rows, settings)
        found.append((made, sorted(tuple(r) for r in made.places.collect())))
    assert found[0] == found[1] and found[0][0].n_hot_groups == 3
    cells = sorted(p + k for g, n, salts, p in found[0][1] if salts > 1 for k in range(salts))
    assert cells == list(range(found[0][0].hot_parts))


def test_targets_go_to_cells_with_candidates_only(spark):
    """Groups above the share of a cell leave no empty cells between them."""
    rng = np.random.default_rng(3)
    targets = targets_df(spark, rng.normal(size=(20, 4)))
    candidates = candidates_df(spark, [(i, "abc"[i % 3], v) for i, v in enumerate(rng.normal(size=(300, 4)))])
    grid = plan_grid(targets, candidates, RetrievalSettings())
    used = {r.part for r in grid.places.collect()}
    assert used == set(range(grid.parts)) and grid.parts == 3
    assert place_targets(targets, grid, hot=False).count() == 3 * 20 * grid.chunks
