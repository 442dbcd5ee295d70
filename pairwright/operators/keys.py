"""Row keys from content."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_COPIES_PER_PILE = 100_000
#: Long columns, which are not read to tell which rows may be repeated.
_LONG = ("description",)
#: Bytes, by the optimizer's estimate, up to which all rows pass one wide shuffle: such a table has few splits, and the
#: shuffle spreads the work. The keys are the same either way.
_SMALL_BYTES = 1 << 30


def with_content_key(df: DataFrame, identity: Sequence[str], name: str, variant: Sequence[Column] | None = None) -> DataFrame:
    """Adds a key: SHA-2 over the identity columns, the variant and the copy number.

    Rows of large tables are counted by a hash of their short columns, eight bytes each, combined before the shuffle. Those
    whose hash comes once, in general nearly all, are keyed in the scan; what is told to them is the list of the repeated
    hashes. The rest are counted by all columns, as interchangeable copies, and written out again with copy numbers, large
    numbers of them in piles spread over the tasks. Rows that agree in the identity only are variants, told apart by the
    texts in `variant` (all other columns if none are given), so the key of a row does not depend on which other rows there are.
    """
    columns = df.columns
    rest = [F.col(c) for c in columns if c not in identity] if variant is None else list(variant)
    hashes = {"_identity": F.sha2(_joined(map(F.col, identity)), 256), "_variant": F.sha2(_joined(rest), 256)}
    if _estimated_bytes(df) <= _SMALL_BYTES:
        return _keyed(_copies(df, hashes, columns), columns, name)
    address = F.xxhash64(*[c for c in columns if c not in _LONG] or columns)
    twice = df.groupBy(address.alias("_address")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_address")
    marked = df.withColumn("_address", address)
    single = marked.join(twice, "_address", "left_anti").drop("_address").withColumns(hashes).withColumn("_copy", F.lit(1).cast("bigint"))
    several = marked.join(twice, "_address", "left_semi").drop("_address")
    return _keyed(single.unionByName(_copies(several, hashes, columns)), columns, name)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _keyed(rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    key = F.sha2(F.concat_ws(":", "_identity", "_variant", "_copy"), 256)
    return rows.select(*columns, key.alias(name))


def _copies(df: DataFrame, hashes: dict[str, Column], columns: Sequence[str]) -> DataFrame:
    """Rows that may be repeated, counted as a whole and written out again with copy numbers."""
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).withColumns(hashes)
    few, many = F.col("_copies") <= _COPIES_PER_PILE, F.col("_copies") > _COPIES_PER_PILE
    one = rows.where(few).withColumn("_pile", F.lit(0).cast("bigint"))
    piles = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copies - 1) div {_COPIES_PER_PILE}"))
    several = rows.where(many).withColumn("_pile", F.explode(piles)).repartition("_identity", "_variant", "_pile")
    rows = one.unionByName(several)
    first = F.col("_pile") * _COPIES_PER_PILE + 1
    last = F.least(F.col("_copies"), (F.col("_pile") + 1) * _COPIES_PER_PILE)
    return rows.withColumn("_copy", F.explode(F.sequence(first, last))).drop("_copies", "_pile")


def _joined(columns: Iterable[Column]) -> Column:
    """The texts with their lengths before them; null as empty."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.concat(F.lit(""), *[F.concat(F.length(p), F.lit(":"), p) for p in parts])
