"""Report tables over the labelled pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright import settings as S
from pairwright.operators.summary import value_counts

LABEL_DIMENSIONS = ("label_category", "label_relation", "label", "label_keep", "label_status")
_TOTALS = ("is_exact_diagnosis", "is_related_lab", "is_related_medication")


def label_counts(merged: DataFrame) -> DataFrame:
    return value_counts(merged, LABEL_DIMENSIONS)


def label_totals(merged: DataFrame) -> DataFrame:
    """Flag totals, failed rows and rows without a code."""
    return merged.agg(*[F.count_if(F.col(c)).alias(c) for c in _TOTALS],
                      F.count_if(F.col("label_status") == S.FAILED).alias("n_failed"),
                      F.count_if(F.col("target_code").isNull()).alias("n_without_code"))


def failed_targets(merged: DataFrame) -> DataFrame:
    """All codes and names with failed rows."""
    failed = merged.where(F.col("label_status") == S.FAILED)
    return failed.select("target_code", "target_name").dropDuplicates()


def failed_preview(merged: DataFrame, n: int = 30) -> DataFrame:
    """The first n of them, for a look."""
    return failed_targets(merged).orderBy("target_code", "target_name").limit(n)


def target_rollup(merged: DataFrame) -> DataFrame:
    """Per code: rows, kept rows, the three flags and failed rows."""
    return merged.where(F.col("target_code").isNotNull()).groupBy("target_code").agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.count_if(F.col("label_keep")).alias("n_keep"),
        F.count_if(F.col("is_exact_diagnosis")).alias("n_exact_diagnosis"),
        F.count_if(F.col("is_related_lab")).alias("n_related_lab"),
        F.count_if(F.col("is_related_medication")).alias("n_related_medication"),
        F.count_if(F.col("label_status") == S.FAILED).alias("n_failed"))
