"""Runs that continue where earlier ones stopped: an append-only log of results, keyed by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright import settings as S
from pairwright.settings import LabelSettings


def latest_per_key(log: DataFrame, keys: Sequence[str], sequence: Sequence[str | Column]) -> DataFrame:
    """The last row of each key. An aggregate, so a key with many rows is reduced before the shuffle."""
    rest = [c for c in log.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*sequence)).alias("last")
    return log.groupBy(*keys).agg(last).select(*keys, "last.*")


def _sequence(log: DataFrame) -> list[Column]:
    """Later runs win; within a run a readable answer does, then the order of the columns' texts."""
    rest = sorted(c for c in log.columns if c not in ("row_key", "run_seq"))
    return [F.col("run_seq"), F.col("label_status") == S.OK, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rest]]


def latest_results(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["row_key"], _sequence(log))


def pending(pairs: DataFrame, log: DataFrame, settings: LabelSettings) -> DataFrame:
    """Pairs still to be classified. Failed and unanswered rows count as pending unless `retry_failed` is off."""
    if not settings.resume:
        return pairs
    done = latest_results(log.select("row_key", "label_status", "run_seq"))
    if settings.retry_failed:
        done = done.where(F.col("label_status") == S.OK)
    return pairs.join(done.select("row_key"), "row_key", "left_anti")
