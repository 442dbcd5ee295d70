"""What the operators of this folder share: written intermediate tables, numbering of ordered rows, batches of text."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

#: The word pattern of the query contracts, and the same white space for `bytes.split`.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in `spark.checkpoint.dir`.

    Where that is unset, the folder of the running context is taken; where there is none either, a temporary folder,
    which only a local master can use.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='pairwright-')}"
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{context.applicationId}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The table written as Parquet in the shared folder and read again: computed once, and safe from lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, unless the session has it."""
    from pairwright.deploy import ship

    ship(spark)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z in lower case; no other letter changes."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, so that what is built for one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def running_start(spans: DataFrame, order: list[str], size: str, start: str = "start") -> DataFrame:
    """Adds the sum of `size` over all rows before this one, without one task that sees all rows.

    The rows are dealt out by range and written with the number of their range; ranges are summed apart, and the sums
    of the ranges before are added. One task sees one range; the one window over ranges has a row for each.
    """
    keys = [F.col(c).asc_nulls_first() for c in order]
    parts = max(1, int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut(spans.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_range").agg(F.sum(size).alias("_in_range"))
        .select("_range", F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0)))
        .join(offsets, "_range")
        .withColumn(start, F.col("_within") + F.col("_offset"))
        .drop("_range", "_within", "_offset")
    )


def plain(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col(f"`{name}`")


def fresh(columns: Iterable[str], name: str) -> str:
    """A column name that none of `columns` has, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_hashes(docs: DataFrame) -> tuple[Column, Column]:
    """Two hashes of a whole row, 128 bits together; columns that hold maps do not count."""
    columns = [plain(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(1), *columns), F.xxhash64(F.lit(2), *columns)


def rows_where(docs: DataFrame, text: str, masks: Callable[[Iterable[pa.Array]], Iterator[pa.Array]]) -> DataFrame:
    """The rows of `docs` whose text passes, all columns as they are, without a shuffle. `masks` gets batches of texts."""
    place = docs.columns.index(text)
    names = docs.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.Array]:
            for batch in pieces(batches, 512):
                held.append(batch)
                yield batch.column(place)

        for mask in masks(texts()):
            kept = held.pop(0).filter(mask)
            yield pa.RecordBatch.from_arrays(kept.columns, names=names)

    return docs.mapInArrow(run, docs.schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))
