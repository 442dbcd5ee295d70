"""Sums over all rows before each row, and positions in files, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairwright.plans.lineage import cut


def sums_before(rows: DataFrame, order: Sequence[str], amounts: dict[str, str]) -> DataFrame:
    """Adds, for each (column: name), the sum of the column over all rows before this one in `order`, nulls first.

    Rows are dealt out by range and written with the number of their range; a task adds up within one range, and the
    sums of the ranges before come from a table with one row for each range. `order` should tell rows apart.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(rows.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()))
    ranges = dealt.groupBy("_range").agg(*[F.sum(c).alias(f"_in_{c}") for c in amounts])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_range", *[F.coalesce(F.sum(f"_in_{c}").over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in amounts])
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.withColumns({f"_within_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in amounts}).join(ranges, "_range")
    out = out.withColumns({name: F.col(f"_within_{c}") + F.col(f"_offset_{c}") for c, name in amounts.items()})
    return out.select(*rows.columns, *amounts.values())


def with_file_position(raw: DataFrame, name: str = "input_order") -> DataFrame:
    """Adds the place of each row over all its Parquet files: files in order of their paths, rows in order within each.

    Each row knows its file and its number there; the files' row counts are added up apart. No row is moved.
    """
    rows = raw.withColumns({"_file": F.xxhash64("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    sizes = raw.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    starts = cut(sums_before(sizes, ["path"], {"n": "start"}).select(F.xxhash64("path").alias("_file"), "start"))
    return rows.join(starts, "_file").withColumn(name, (F.col("start") + F.col("_row")).cast("bigint")).select(*raw.columns, name)
