"""Labels merged into the pairs, derived columns and the final order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright import settings as S
from pairwright.functions.labels import final_label, is_exact_diagnosis, is_related, lookup
from pairwright.functions.numbers import to_number
from pairwright.operators.columns import ensure_columns
from pairwright.operators.ranking import descending_bins, row_number_within
from pairwright.settings import LabelSettings
from pairwright.sources.names import LABEL_COLUMNS

_BINS = 2_048


def with_derived(df: DataFrame, settings: LabelSettings) -> DataFrame:
    """Final label, three flags and the two sort ranks, from relation and category."""
    relation, category = F.col("label_relation"), F.col("label_category")
    return df.withColumns({
        "label": final_label(relation, category),
        "is_exact_diagnosis": is_exact_diagnosis(relation, category),
        "is_related_lab": is_related("lab", relation, category),
        "is_related_medication": is_related("medication", relation, category),
        "relation_rank": lookup(relation, settings.relation_ranks, S.UNKNOWN_RANK),
        "category_rank": lookup(category, settings.category_ranks, S.UNKNOWN_RANK),
    })


def merge_labels(pairs: DataFrame, results: DataFrame, settings: LabelSettings) -> DataFrame:
    """Every pair once, with its label or the defaults. Missing scores stay null unless `fill_score` is set."""
    columns = [c for c in LABEL_COLUMNS if c in results.columns]
    rows = pairs.join(results.select("row_key", *columns), "row_key", "left")
    priority = to_number(F.col("label_priority")) if "label_priority" in columns else F.lit(None)
    rows = rows.withColumns({
        "label_category": F.coalesce("label_category", F.lit("unrelated")),
        "label_relation": F.coalesce("label_relation", F.lit("unrelated")),
        "label_keep": F.coalesce("label_keep", F.lit(False)),
        "label_priority": F.coalesce(priority.cast("int"), F.lit(S.LOWEST_PRIORITY)),
        "label_reason": F.coalesce("label_reason", F.lit(S.REASON_MISSING)),
        "label_status": F.coalesce("label_status", F.lit(S.MISSING)) if "label_status" in columns
        else F.lit(S.UNKNOWN),
        "label_error": F.coalesce("label_error", F.lit("")) if "label_error" in columns else F.lit(""),
    })
    score = to_number(F.col("score")) if "score" in rows.columns else F.lit(None).cast("double")
    if settings.fill_score is not None:
        score = F.coalesce(score, F.lit(settings.fill_score))
    return with_derived(rows.withColumn("score", score), settings)


def final_rank(merged: DataFrame, settings: LabelSettings) -> DataFrame:
    """Adds `final_rank` within the code: priority, relation, category, score, stage-one rank. Null codes get none."""
    rows = ensure_rank_columns(merged)
    coded = rows.where(F.col("target_code").isNotNull())
    score, place = F.col("score"), F.col("target_rank")
    order = [F.col("label_priority"), F.col("relation_rank"), F.col("category_rank"), score.desc_nulls_last(),
             place.asc_nulls_last(), F.col("row_key")]
    coarse = [F.col("label_priority"), F.col("relation_rank"), F.col("category_rank"),
              descending_bins(score, _BINS)]
    fine = [F.coalesce(-score, F.lit(float("inf"))),
            F.coalesce(F.greatest(F.least(F.floor(place / 1024), F.lit(2**61)), F.lit(-(2**61))), F.lit(2**62)),
            F.when(place.isNull(), F.substring("row_key", 1, 3)).otherwise(F.lit(""))]
    ranked = row_number_within(coded, ["target_code"], [coarse, fine], order, "final_rank", settings.window_rows)
    rest = rows.where(F.col("target_code").isNull()).withColumn("final_rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest)


def ensure_rank_columns(df: DataFrame) -> DataFrame:
    if "target_rank" not in df.columns:
        df = df.withColumn("target_rank", F.lit(None).cast("double"))
    return ensure_columns(df, ["row_key"])
