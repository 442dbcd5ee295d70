"""Adaptive selection of candidates per (target, group).

threshold = best score - scale * spread; the scores at or above it are kept, padded with the next best up to
`min_candidates` and cut to the best `max_candidates`. The result is a prefix of the descending order.

A group that fits one cell is solved there. A split group takes three passes over the same shuffled cells:
bins of all scores -> exact median and spread from the few bins that can hold them -> count at the threshold and best
pairs. Where these few bins still hold very many distinct scores (near-copies), they are counted again in finer bins
first. Every pass ships counts or bounded lists, never the pairs.
"""

from __future__ import annotations

from functools import partial
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pairwright.operators import cells
from pairwright.operators.grid import (
    CELL, Grid, place_bounds, place_candidates, place_groups, place_targets, plan_grid,
)
from pairwright.operators.ranking import descending_bins, spread_row_number
from pairwright.plans.lineage import cut
from pairwright.settings import RetrievalSettings

_STATS = {"n_pool": "bigint", "n_above": "bigint", "max_in_group": "double", "delta": "double",
          "threshold": "double"}
_PAIR = {"score": "double", "rank_in_group": "bigint"}


def _ready(targets: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    group = F.coalesce(F.col("group").cast("string"), F.lit("UNKNOWN_GROUP")).alias("group")
    return targets.select("target_id", "embedding"), candidates.select("cand_id", group, "embedding")


def _types(df: DataFrame, columns: dict[str, str]) -> tuple[T.StructType, dict[str, pa.DataType]]:
    """The columns as a schema and as Arrow types."""
    schema = ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())
    empty = df.sparkSession.createDataFrame([], schema).schema
    return empty, {f.name: to_arrow_type(f.dataType) for f in empty.fields}


def _cogroup(left: DataFrame, right: DataFrame, make, columns: dict[str, str]) -> DataFrame:
    """Run a cell function over the cells of both sides."""
    schema, types = _types(left, columns)
    return left.groupBy(*CELL).cogroup(right.groupBy(*CELL)).applyInArrow(make(types), schema)


def _most(df: DataFrame, column: str) -> int:
    return df.agg(F.max(column)).first()[0] or 0


def _dtype(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _key_types(targets: DataFrame, candidates: DataFrame) -> dict[str, str]:
    return {"target_id": _dtype(targets, "target_id"), "group": "string", "cand_id": _dtype(candidates, "cand_id")}


_FINER = 4_096
_FINEST = 2**47


def _first_bins(profiles: DataFrame) -> DataFrame:
    """All bins of a group, each of them still a place for the median and for the distance."""
    key = Window.partitionBy("target_id", "group")
    bins = profiles.groupBy("target_id", "group", "bin").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
    bins = bins.withColumns({"n_pool": F.sum("n").over(key), "max_in_group": F.max("top").over(key)})
    return bins.withColumns({
        "p1": F.expr("(n_pool + 1) div 2"), "p2": F.expr("n_pool div 2 + 1"), "several": F.col("n"),
        "was_mid": F.lit(True), "was_ring": F.lit(True),
        "under_mid": F.lit(0).cast("bigint"), "under_ring": F.lit(0).cast("bigint")})


def _next_bins(finer: DataFrame) -> DataFrame:
    """The finer bins inside those that were wanted before."""
    key = Window.partitionBy("target_id", "group")
    bins = finer.groupBy("target_id", "group", "bin").agg(
        F.sum("n").alias("n"), F.sum("several").alias("several"), F.first("carry", ignorenulls=True).alias("carry"))
    bins = bins.withColumn("carry", F.first("carry", ignorenulls=True).over(key))
    bins = bins.select("target_id", "group", "bin", "n", "several", "carry.*")
    before = F.floor(F.col("bin") / _FINER)
    return bins.withColumns({"was_mid": F.array_contains("mid_bins", before),
                             "was_ring": F.array_contains("ring_bins", before)})


def _median_bounds(bins: DataFrame, unit: int) -> DataFrame:
    """Which bins of width 1/unit can hold the median score and the median distance from it.

    With the median inside [m_lo, m_hi], a score in [lo, hi) is at a distance between d_lo and d_hi from it. Counting
    by d_hi bounds the wanted distance from above, counting by d_lo bounds it from below.
    """
    key = Window.partitionBy("target_id", "group")

    def upto(flag: str, order: str) -> Column:
        return F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).over(key.orderBy(order))

    def holds(position: str) -> Column:
        place = F.col(position) - F.col("under_mid")
        return F.col("was_mid") & (F.col("cum") - F.col("n") < place) & (place <= F.col("cum"))

    def reach(cum: str, position: str, value: str) -> Column:
        enough = F.col("was_ring") & (F.col(cum) >= F.col(position) - F.col("under_ring"))
        return F.min(F.when(enough, F.col(value))).over(key)

    out = (
        bins.withColumns({"cum": upto("was_mid", "bin"), "lo": F.col("bin") / unit, "hi": (F.col("bin") + 1) / unit})
        .withColumns({"held": holds("p1"), "held2": holds("p2")})
        .withColumns({"m_lo": F.min(F.when(F.col("held"), F.col("lo"))).over(key),
                      "m_hi": F.max(F.when(F.col("held2"), F.col("hi"))).over(key)})
        .withColumns({"d_lo": F.greatest(F.col("lo") - F.col("m_hi"), F.col("m_lo") - F.col("hi"), F.lit(0.0)),
                      "d_hi": F.greatest(F.col("hi") - F.col("m_lo"), F.col("m_hi") - F.col("lo"))})
        .withColumns({"by_lo": upto("was_ring", "d_lo"), "by_hi": upto("was_ring", "d_hi")})
        .withColumns({"r_lo": reach("by_lo", "p1", "d_lo"), "r_hi": reach("by_hi", "p2", "d_hi")})
        .withColumns({"mid": F.col("held") | F.col("held2"),
                      "ring": F.col("was_ring") & (F.col("d_hi") >= F.col("r_lo")) & (F.col("d_lo") <= F.col("r_hi"))})
    )
    n, bin_, wanted = F.col("n"), F.col("bin"), F.col("mid") | F.col("ring")
    below_mid = F.col("was_mid") & (F.col("hi") <= F.col("m_lo"))
    below_ring = F.col("was_ring") & (F.col("d_hi") < F.col("r_lo"))
    out = out.groupBy("target_id", "group", "n_pool", "p1", "p2", "max_in_group").agg(
        F.collect_list(F.when(wanted, bin_)).alias("bins"),
        F.sum(F.when(wanted, F.col("several")).otherwise(0)).alias("n_wanted"),
        F.collect_list(F.when(F.col("ring"), bin_)).alias("ring_bins"),
        F.collect_list(F.when(F.col("mid"), bin_)).alias("mid_bins"),
        (F.max("under_mid") + F.sum(F.when(below_mid, n).otherwise(0))).alias("under_mid"),
        (F.max("under_ring") + F.sum(F.when(below_ring, n).otherwise(0))).alias("under_ring"),
    )
    return out.select("target_id", "group", "bins", "n_wanted", F.struct(
        "n_pool", "p1", "p2", "max_in_group", "ring_bins", "mid_bins", "under_mid", "under_ring").alias("carry"))


def _exact_spread(values: DataFrame, unit: int, settings: RetrievalSettings) -> DataFrame:
    """Median and median distance from the distinct scores of the wanted bins."""
    key = Window.partitionBy("target_id", "group")
    rows = values.groupBy("target_id", "group", "value").agg(
        F.sum("n").alias("n"), F.first("carry", ignorenulls=True).alias("carry"))
    rows = rows.withColumn("carry", F.first("carry", ignorenulls=True).over(key))
    rows = rows.select("target_id", "group", "value", "n", "carry.*")
    bin_ = F.floor(F.col("value") * unit)

    def at(value: str, cum: str, position: Column) -> Column:
        return F.min(F.when(F.col(cum) >= position, F.col(value))).over(key)

    def running(flag: str, order: str) -> Column:
        counted = F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).over(key.orderBy(order))
        return F.when(F.col(flag), counted)

    def middle(value: str, cum: str, under: str) -> Column:
        lower, upper = F.col("p1") - F.col(under), F.col("p2") - F.col(under)
        return (at(value, cum, lower) + at(value, cum, upper)) / 2

    rows = rows.withColumns({"is_mid": F.array_contains("mid_bins", bin_),
                             "is_ring": F.array_contains("ring_bins", bin_)})
    rows = rows.withColumn("mid_cum", running("is_mid", "value"))
    rows = rows.withColumn("distance", F.abs(F.col("value") - middle("value", "mid_cum", "under_mid")))
    rows = rows.withColumn("ring_cum", running("is_ring", "distance"))
    rows = rows.withColumn("mad", middle("distance", "ring_cum", "under_ring"))
    return rows.groupBy("target_id", "group", "n_pool", "max_in_group").agg(
        (F.first("mad") * settings.scale).alias("delta"))


def _deviations(placed: DataFrame, everywhere: DataFrame, settings: RetrievalSettings, grid: Grid, keys: dict[str, str]) -> DataFrame:
    """(target, group, spread) of the split groups that are large for the width of their vectors: the candidates alone are
    summed up, part by part, and a target needs the covariance of a group only."""
    parts, types = _types(placed, {"group": "string", "n": "bigint", "width": "bigint", "sums": "binary"})
    sums = placed.where("chunk = 0").groupBy(*CELL).applyInArrow(cells.moments(types), parts)
    whole, types = _types(placed, {"group": "string", "covariance": "array<double>"})
    groups = sums.groupBy("group").applyInArrow(cells.covariance(types), whole)
    return _cogroup(place_groups(groups, grid, settings), everywhere, cells.deviations, keys | {"spread": "double"})


def _merged_moments(moments: DataFrame, deviations: DataFrame, settings: RetrievalSettings) -> DataFrame:
    """Population standard deviation from the covariance of the group, or from the exact sums of the parts."""
    moments = moments.unionByName(deviations, allowMissingColumns=True)
    n, scale = F.sum("n"), F.lit(float(1 << 40))
    mean = F.sum("s1").cast("double") / n / scale
    square = F.sum("s2").cast("double") / n / scale / scale
    spread = F.coalesce(F.max("spread"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))))
    return moments.groupBy("target_id", "group").agg(
        n.alias("n_pool"), F.max("top").alias("max_in_group"), (spread * settings.scale).alias("delta"))


def _split_groups(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings, grid: Grid,
                  pairs: bool) -> DataFrame:
    ids = _key_types(targets, candidates)
    keys = {name: ids[name] for name in ("target_id", "group")}
    placed = place_candidates(candidates, grid, settings, hot=True)
    everywhere = place_targets(targets, grid, hot=True)

    def in_cells(bounds: DataFrame) -> DataFrame:
        return place_bounds(targets, bounds, grid, settings)

    if settings.spread == "sd":
        columns = keys | {"n": "bigint", "top": "double", "s1": "decimal(38,0)", "s2": "decimal(38,0)"}
        stats = _merged_moments(
            _cogroup(placed, everywhere, lambda t: cells.profile(settings, t), columns),
            _deviations(placed, everywhere, settings, grid, keys), settings)
    else:
        columns = keys | {"bin": "bigint", "n": "bigint", "top": "double"}
        bins = _cogroup(placed, everywhere, lambda t: cells.profile(settings, t), columns)
        unit, bounds = settings.bins_per_unit, cut(_median_bounds(_first_bins(bins), settings.bins_per_unit))
        while unit * _FINER <= _FINEST and _most(bounds, "n_wanted") > settings.value_rows:
            placed_bounds, coarse = in_cells(bounds.drop("n_wanted")), unit
            columns = keys | {"bin": "bigint", "n": "bigint", "several": "bigint",
                              "carry": _dtype(placed_bounds, "carry")}
            finer = _cogroup(placed, placed_bounds, partial(cells.finer_bins, coarse, coarse * _FINER), columns)
            unit = coarse * _FINER
            bounds = cut(_median_bounds(_next_bins(finer), unit))
        bounds = in_cells(bounds.drop("n_wanted"))
        columns = keys | {"value": "double", "n": "bigint", "carry": _dtype(bounds, "carry")}
        stats = _exact_spread(_cogroup(placed, bounds, partial(cells.wanted_values, unit), columns), unit, settings)
    stats = stats.withColumn("threshold", F.col("max_in_group") - F.col("delta"))
    bounds = in_cells(stats.select("target_id", "group", F.struct(
        "n_pool", "max_in_group", "delta", "threshold").alias("carry")))

    limit = settings.max_candidates if pairs else 1
    columns = ids | {"score": "double", "above": "bigint", "carry": _dtype(bounds, "carry")}
    found = _cogroup(placed, bounds, lambda t: cells.best_of_part(limit, t), columns)
    if not pairs:
        return found.groupBy("target_id", "group").agg(
            F.sum("above").alias("n_above"), F.first("carry", ignorenulls=True).alias("carry")
        ).select("target_id", "group", "n_above", "carry.*")
    found = cut(found)
    counts = found.groupBy("target_id", "group").agg(
        F.sum("above").alias("n_above"), F.first("carry", ignorenulls=True).alias("carry"))
    key = Window.partitionBy("target_id", "group").orderBy(F.desc("score"), "cand_id")
    best = found.select("target_id", "group", "cand_id", "score", F.row_number().over(key).alias("rank_in_group"))
    best = best.where(F.col("rank_in_group") <= limit).withColumn("rank_in_group", F.col("rank_in_group").cast("bigint"))
    return best.join(counts, ["target_id", "group"]).select("*", "carry.*").where(
        F.col("rank_in_group") <= selected_count(settings))


def selected_count(settings: RetrievalSettings) -> Column:
    """How many of a pool are kept."""
    padded = F.least(F.lit(settings.min_candidates), F.col("n_pool"))
    return F.least(F.greatest(F.col("n_above"), padded), F.lit(settings.max_candidates)).cast("bigint")


def _outcome(df: DataFrame, settings: RetrievalSettings) -> DataFrame:
    """Counts and flags that follow from the pool size and the count at the threshold."""
    padded = F.greatest(F.col("n_above"), F.least(F.lit(settings.min_candidates), F.col("n_pool")))
    return df.withColumns({
        "n_selected": selected_count(settings),
        "min_padded": (F.col("n_above") < settings.min_candidates).cast("int"),
        "max_capped": (padded > settings.max_candidates).cast("int"),
    })


def _sides(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings, grid: Grid, pairs: bool,
           columns: dict[str, str]) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of the whole groups, with `columns`, and of the split ones; None where there are none."""
    whole = split = None
    if grid.has_small or not grid.has_hot:
        whole = _cogroup(place_candidates(candidates, grid, settings, hot=False), place_targets(targets, grid, hot=False),
                         lambda t: cells.whole_groups(settings, t, pairs), columns)
    if grid.has_hot:
        split = _split_groups(targets, candidates, settings, grid, pairs)
    return whole, split


def _together(sides: list[DataFrame | None]) -> DataFrame:
    whole, split = sides
    if whole is None or split is None:
        return whole if split is None else split
    return whole.unionByName(split)


def _list_types(ids: dict[str, str]) -> dict[str, str]:
    return {name: ids[name] for name in ("target_id", "group")} | _STATS | {
        "cand_ids": f"array<{ids['cand_id']}>", "scores": "array<double>"}


def _listed(pairs: DataFrame) -> DataFrame:
    """One row for each target and group, with its pairs in lists, best first."""
    pair = F.struct("rank_in_group", "cand_id", "score")
    rows = pairs.groupBy("target_id", "group").agg(
        *[F.first(name).alias(name) for name in _STATS], F.array_sort(F.collect_list(pair)).alias("pairs"))
    return rows.select("target_id", "group", *_STATS, F.col("pairs.cand_id").alias("cand_ids"), F.col("pairs.score").alias("scores"))


def _unlisted(lists: DataFrame) -> DataFrame:
    """A row for each pair of the lists."""
    others = [c for c in lists.columns if c not in ("target_id", "group", "cand_ids", "scores")]
    rows = lists.select("target_id", "group", *others, "scores", F.posexplode("cand_ids").alias("place", "cand_id"))
    return rows.select("target_id", "group", "cand_id", F.get("scores", "place").alias("score"),
                       (F.col("place") + 1).cast("bigint").alias("rank_in_group"), *others)


def group_statistics(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings,
                     grid: Grid | None = None) -> DataFrame:
    """One row per (target, group): pool size, best score, spread, threshold, counts and flags."""
    targets, candidates = _ready(targets, candidates)
    grid = grid or plan_grid(targets, candidates, settings)
    columns = _key_types(targets, candidates) | _STATS
    del columns["cand_id"]
    whole, split = _sides(targets, candidates, settings, grid, False, columns)
    return _outcome(_together([whole, None if split is None else split.select(*columns)]), settings)


def adaptive_select(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings,
                    grid: Grid | None = None) -> DataFrame:
    """The selected pairs with their rank in the group and the group's statistics.

    `targets` has (target_id, embedding), `candidates` (cand_id, group, embedding); ids are unique.
    """
    targets, candidates = _ready(targets, candidates)
    grid = grid or plan_grid(targets, candidates, settings)
    ids = _key_types(targets, candidates)
    whole, split = _sides(targets, candidates, settings, grid, True, _list_types(ids))
    columns = [*ids, *_PAIR, *_STATS]
    rows = _together([None if side is None else side.select(*columns) for side in (None if whole is None else _unlisted(whole), split)])
    return _outcome(rows, settings)


def rank_over_groups(selected: DataFrame, settings: RetrievalSettings, n_groups: int | None = None) -> DataFrame:
    """Adds the rank within the target over all its groups, and the target's best score over all candidates.

    Each group keeps its best pair, so the best selected score of a target is its best score of all. A target has at
    most groups x max_candidates rows; where that is no longer small, the ranking is spread over many tasks.
    """
    order = [F.desc("score"), F.col("group"), F.col("rank_in_group")]
    if n_groups is not None and n_groups * settings.max_candidates <= settings.window_rows:
        key = Window.partitionBy("target_id")
        return selected.withColumns({
            "max_for_target": F.max("max_in_group").over(key),
            "target_rank": F.row_number().over(key.orderBy(*order)).cast("bigint"),
        })
    best = selected.groupBy("target_id").agg(F.max("max_in_group").alias("max_for_target"))
    coarse = [descending_bins(F.col("score"), settings.bins_per_unit)]
    fine = [-F.col("score"), F.col("group")]
    ranked = spread_row_number(selected, ["target_id"], [coarse, fine], order, "target_rank")
    return ranked.join(best, "target_id")


def select_and_rank(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings) -> DataFrame:
    """Adaptive selection plus the ranks over all groups of a target.

    Pairs go to the task of their target in lists, one for each target and group, so that the statistics of a group travel once
    and a pair is an id and a score; they become rows where they are ranked.
    """
    targets, candidates = _ready(targets, candidates)
    grid = plan_grid(targets, candidates, settings)
    if grid.n_groups * settings.max_candidates > settings.window_rows:
        return rank_over_groups(adaptive_select(targets, candidates, settings, grid), settings, grid.n_groups)
    whole, split = _sides(targets, candidates, settings, grid, True, _list_types(_key_types(targets, candidates)))
    lists = _outcome(_together([whole, None if split is None else _listed(split)]), settings)
    most = grid.n_targets * min(grid.n_candidates, grid.n_groups * settings.max_candidates)
    lists = lists.repartition(max(grid.width, ceil(most / settings.window_rows)), "target_id")
    key = Window.partitionBy("target_id")
    rows = _unlisted(lists.withColumn("max_for_target", F.max("max_in_group").over(key)))
    return rows.withColumn("target_rank", F.row_number().over(key.orderBy(F.desc("score"), "group", "rank_in_group")).cast("bigint"))
