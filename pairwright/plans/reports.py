"""The reports of both stages, as tables by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from pairwright.operators import report, summary
from pairwright.settings import RetrievalSettings


def retrieval_report(selected: DataFrame, by_target: DataFrame, by_group: DataFrame, settings: RetrievalSettings,
                     codes: Iterable[str] = ()) -> dict[str, DataFrame]:
    """Distributions of the candidate counts, the largest of them, and samples for the wanted codes."""
    codes = tuple(codes)
    tables = {
        "target_counts": summary.count_describe(by_target),
        "target_quantiles": summary.count_quantiles(by_target),
        "target_buckets": summary.count_buckets(by_target),
        "top_targets": summary.top_targets(by_target),
        "group_counts": summary.count_describe(by_group),
        "group_quantiles": summary.count_quantiles(by_group),
        "group_buckets": summary.group_buckets(by_group, settings),
        "top_groups": summary.top_groups(by_group),
    }
    if codes:
        tables["sample"] = summary.inspect_top(selected, codes)
        tables["sample_by_group"] = summary.inspect_by_group(selected, codes)
    return tables


def candidate_report(candidates: DataFrame) -> DataFrame:
    """How many candidates each study and each group has."""
    return summary.value_counts(candidates, ("study", "group"))


def labelling_report(ranked: DataFrame) -> dict[str, DataFrame]:
    """Label counts and totals, the failed targets and the roll-up per target."""
    return {
        "label_counts": report.label_counts(ranked),
        "label_totals": report.label_totals(ranked),
        "failed_targets": report.failed_targets(ranked),
        "failed_targets_preview": report.failed_preview(ranked),
        "by_target": report.target_rollup(ranked),
        "by_target_preview": report.target_rollup(ranked).orderBy("target_code").limit(20),
    }
