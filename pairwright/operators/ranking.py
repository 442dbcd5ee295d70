"""Row numbers within keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_number_within(df: DataFrame, keys: Sequence[str], tiers: Sequence[Sequence[Column]],
                      order: Sequence[Column], name: str, limit: int) -> DataFrame:
    """`row_number` over `keys` in `order`: one window while no key has more than `limit` rows, else spread.

    The check is a count by key; give it a written or checkpointed table.
    """
    largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if largest > limit:
        return spread_row_number(df, keys, tiers, order, name)
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))


def spread_row_number(df: DataFrame, keys: Sequence[str], tiers: Sequence[Sequence[Column]],
                      order: Sequence[Column], name: str) -> DataFrame:
    """`row_number` over `keys` in `order` without bringing a key into one task.

    `tiers` is a coarse and a fine list of ascending columns, each never null and each in line with `order`: rows that
    differ in a tier compare as the tier does. Rows are counted per tier value (a map-side combined aggregate), the
    counts before each value become offsets, and only rows that share all tier values are numbered together.
    """
    coarse = [f"_c{i}" for i in range(len(tiers[0]))]
    fine = [f"_f{i}" for i in range(len(tiers[1]))]
    keys = list(keys)
    rows = df.withColumns(dict(zip(coarse + fine, [*tiers[0], *tiers[1]])))
    before = lambda part, by: F.coalesce(F.sum("_n").over(
        Window.partitionBy(*part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = rows.groupBy(*keys, *coarse, *fine).agg(F.count(F.lit(1)).alias("_n"))
    blocks = counts.groupBy(*keys, *coarse).agg(F.sum("_n").alias("_n"))
    blocks = blocks.select(*keys, *coarse, before(keys, coarse).alias("_before_block"))
    offsets = counts.select(*keys, *coarse, *fine, before(keys + coarse, fine).alias("_before"))
    offsets = _same(offsets, blocks, keys + coarse)
    out = _same(rows, offsets, keys + coarse + fine)
    number = F.row_number().over(Window.partitionBy(*keys, *coarse, *fine).orderBy(*order))
    out = out.withColumn(name, (number + F.col("_before") + F.col("_before_block")).cast("bigint"))
    return out.drop(*coarse, *fine, "_before", "_before_block")


def descending_bins(score: Column, bins: int) -> Column:
    """A coarse tier for `score` descending, nulls last: whole numbers, also for infinite scores, and NaN before all."""
    edge = F.lit(2**61)
    bin_ = F.greatest(F.least(F.floor(score * bins), edge), -edge)
    return F.when(score.isNull(), F.lit(2**62)).when(F.isnan(score), F.lit(-(2**62))).otherwise(-bin_)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys))
