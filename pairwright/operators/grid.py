"""Where each candidate and each target meet: cells of bounded size.

Every target has to be scored against every candidate, but the pairs are never rows of a table. Candidates are
placed in numbered cells by their group; a group with more than `cell_rows` candidates is salted over several. Targets are
copied to the cells they meet, and both sides are hash partitioned by the cell key, so that each Python call sees one
cell. Only what a cell derives from its scores (selected pairs, counts, bounds) leaves it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwright.operators.numbering import sums_before
from pairwright.plans.lineage import cut
from pairwright.settings import RetrievalSettings

CELL = ("part", "chunk")
#: Groups up to which one task adds up their sizes; beyond, ranges of groups do. The numbers are the same.
_GROUPS_IN_A_TASK = 100_000
_TARGETS_WORTH_A_CELL = 16_384
_CELLS_PER_CORE = 4


@dataclass(frozen=True)
class Grid:
    """Sizes the placement needs, from one narrow count of each side, and which cells a group has.

    `places` has (group, n, salts, part): the first cell of a group. Cells are numbered without gaps, split groups and
    whole ones apart; a split group has `salts` cells of its own, and whole groups share one while their rows fit.
    """

    n_targets: int
    n_candidates: int
    n_groups: int
    n_hot_groups: int
    cell_rows: int
    parts: int
    hot_parts: int
    chunks: int
    hot_chunks: int
    width: int
    places: DataFrame = field(compare=False, repr=False)

    @property
    def has_small(self) -> bool:
        return self.n_groups > self.n_hot_groups

    @property
    def has_hot(self) -> bool:
        return self.n_hot_groups > 0

    def partitions(self, hot: bool) -> int:
        """Enough for the cells to spread, and no more than the session's shuffle width."""
        cells = self.hot_parts * self.hot_chunks if hot else self.parts * self.chunks
        return min(self.width, 4 * cells)


def group_sizes(candidates: DataFrame, cell_rows: int) -> DataFrame:
    """(group, n, salts): how many candidates a group has and over how many cells it is spread."""
    sizes = candidates.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("salts", F.ceil(F.col("n") / cell_rows).cast("int"))


def plan_grid(targets: DataFrame, candidates: DataFrame, settings: RetrievalSettings) -> Grid:
    """Count both sides (one column each), once, and size and number the cells from the counts.

    Cells are as many as three for each partition of the session, as far as there are groups, and their targets so few
    that one call returns about `cell_output` pairs at most.
    """
    sample = candidates.select(F.size("embedding").alias("width")).first()
    widest = settings.cell_values // max(sample.width if sample else 1, 1)
    cell_rows, cell_targets = min(settings.cell_rows, widest), min(settings.cell_targets, widest)
    sizes = cut(group_sizes(candidates, cell_rows))
    hot = F.col("salts") > 1
    row = sizes.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(hot).alias("hot_groups"),
        F.coalesce(F.sum(F.when(hot, F.col("salts"))), F.lit(0)).alias("hot_cells"),
        F.coalesce(F.sum(F.when(~hot, F.col("n"))), F.lit(0)).alias("small_rows"),
    ).first()
    n_targets = targets.count()
    width = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, min(cell_rows, ceil(row.small_rows / (3 * width))))
    places = _numbered(sizes.withColumns({
        "_rows": F.when(hot, F.lit(0)).otherwise(F.col("n")), "_cells": F.when(hot, F.col("salts")).otherwise(F.lit(0))}), row.groups)
    part = F.when(hot, F.col("_cells_before")).otherwise(F.floor(F.col("_rows_before") / share)).cast("int")
    places = _without_gaps(places.select(*sizes.columns, part.alias("part")))
    kept = F.sum(F.least("n", F.lit(settings.max_candidates)))
    most = places.where("salts = 1").groupBy("part").agg(kept.alias("kept")).agg(F.max("kept"), F.max("part")).first()
    parts, hot_parts = (most[1] or 0) + 1, max(int(row.hot_cells), 1)
    cores = candidates.sparkSession.sparkContext.defaultParallelism

    def chunks(out: int, cells: int) -> int:
        """Candidates are copied to each, so there are no more than bounds and cores ask for."""
        busy = min(ceil(n_targets / _TARGETS_WORTH_A_CELL), ceil(_CELLS_PER_CORE * cores / cells))
        return max(ceil(n_targets / cell_targets), ceil(n_targets * out / settings.cell_output), busy, 1)

    return Grid(
        n_targets=n_targets,
        n_candidates=row.rows,
        n_groups=row.groups,
        n_hot_groups=row.hot_groups,
        cell_rows=cell_rows,
        parts=parts,
        hot_parts=hot_parts,
        chunks=chunks(most[0] or 0, parts),
        hot_chunks=chunks(max(settings.max_candidates, 2 * settings.bins_per_unit if settings.spread == "mad" else 1), hot_parts),
        width=width,
        places=places,
    )


def _numbered(sizes: DataFrame, groups: int) -> DataFrame:
    """Adds the rows of whole groups and the cells of split ones before each group, in order of the groups."""
    amounts = {"_rows": "_rows_before", "_cells": "_cells_before"}
    if groups > _GROUPS_IN_A_TASK:
        return cut(sums_before(sizes, ["group"], amounts))
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumns({name: F.coalesce(F.sum(c).over(before), F.lit(0)) for c, name in amounts.items()})


def _without_gaps(places: DataFrame) -> DataFrame:
    """Numbers the cells of whole groups anew: a group above the share leaves numbers out, and every target would be
    copied to the cells that nobody is in. They are at most as many as the plan asks for, or full cells."""
    used = places.where("salts = 1").select("part").distinct()
    used = used.select(F.col("part").alias("_given"), (F.row_number().over(Window.orderBy("part")) - 1).alias("_part"))
    places = places.join(F.broadcast(used), (F.col("salts") == 1) & (F.col("part") == F.col("_given")), "left")
    return places.withColumn("part", F.coalesce("_part", "part")).drop("_given", "_part")


def _places(grid: Grid, settings: RetrievalSettings, hot: bool) -> DataFrame:
    """(group, salts, part) of the split groups or of the others; broadcast only while there are few of them."""
    found = grid.places.where("salts > 1" if hot else "salts = 1").select("group", "salts", F.col("part").alias("first"))
    few = (grid.n_hot_groups if hot else grid.n_groups - grid.n_hot_groups) <= settings.broadcast_rows
    return F.broadcast(found) if few else found


def _by_cell(df: DataFrame, grid: Grid, hot: bool) -> DataFrame:
    return df.repartition(grid.partitions(hot), *CELL)


def place_candidates(candidates: DataFrame, grid: Grid, settings: RetrievalSettings, hot: bool) -> DataFrame:
    """One row per candidate and target chunk: cell key, group, id and vector."""
    rows = candidates.select("group", "cand_id", F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.join(_places(grid, settings, hot), "group")
    part = (F.col("first") + F.pmod(F.xxhash64("cand_id"), F.col("salts"))).cast("int").alias("part")
    chunks = grid.hot_chunks if hot else grid.chunks
    chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))) if chunks > 1 else F.lit(0)
    return _by_cell(rows.select(part, chunk.alias("chunk"), "group", "cand_id", "embedding"), grid, hot)


def _chunked(targets: DataFrame, chunks: int) -> DataFrame:
    chunk = F.pmod(F.xxhash64("target_id"), F.lit(chunks)).cast("int").alias("chunk")
    return targets.select("target_id", chunk, F.col("embedding").cast("array<float>").alias("embedding"))


def place_targets(targets: DataFrame, grid: Grid, hot: bool) -> DataFrame:
    """Every target in every part of its chunk."""
    parts, chunks = (grid.hot_parts, grid.hot_chunks) if hot else (grid.parts, grid.chunks)
    spread = _chunked(targets, chunks).repartition(grid.partitions(hot), "target_id")
    spread = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return _by_cell(spread.select("part", "chunk", "target_id", "embedding"), grid, hot)


def place_bounds(targets: DataFrame, bounds: DataFrame, grid: Grid, settings: RetrievalSettings) -> DataFrame:
    """Rows of `bounds` (target_id, group, ...) with the target's vector, in every cell of the group."""
    rows = bounds.join(_places(grid, settings, hot=True), "group").join(_chunked(targets, grid.hot_chunks), "target_id")
    rows = rows.withColumn("part", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("salts") - 1)))
    return _by_cell(rows.drop("first", "salts"), grid, hot=True)


def place_groups(groups: DataFrame, grid: Grid, settings: RetrievalSettings) -> DataFrame:
    """Rows of `groups` (group, ...) of split groups, once for each chunk of the targets, in the first cell of the group."""
    rows = groups.join(_places(grid, settings, hot=True), "group").withColumnRenamed("first", "part")
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(grid.hot_chunks - 1))))
    return _by_cell(rows.drop("salts"), grid, hot=True)
