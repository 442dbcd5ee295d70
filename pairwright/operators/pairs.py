"""Stage-one pairs made ready for labelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairwright.functions.codes import normalize_code, with_codes
from pairwright.functions.numbers import to_number
from pairwright.functions.text import base_name, clean, key_form, short_hash
from pairwright.operators.columns import ensure_columns, require_columns
from pairwright.operators.keys import with_content_key
from pairwright.settings import LabelSettings
from pairwright.sources.names import CANDIDATE_COLUMNS

REQUIRED = ("target_code", "target_name", "target_category", "accession", "name", "description")
OPTIONAL = ("type", "study", "dataset_accession", "dataset_name", "database", "form_name", "table_name", "visit",
            "visit_name", "collection_event", "score", "target_rank", "passed", "pass_label")
IDENTITY = ("target_code", "target_name", "target_category", *CANDIDATE_COLUMNS)

# The texts that mean "passed", and the shortest description that names a context group.
PASS_TEXTS = ("true", "1", "1.0", "yes")
MIN_DESCRIPTION = 12

# Numbers that agree to this share of one are one variant of a row.
_SCALE = 1e9


def keep_passed(df: DataFrame, column: str = "passed") -> DataFrame:
    """Rows marked as passed; all rows where none is marked."""
    mark = F.coalesce(F.lower(F.col(column).cast("string")).isin(*PASS_TEXTS), F.lit(False))
    any_passed = df.agg(F.coalesce(F.bool_or(mark), F.lit(False)).alias("any_passed")).scalar()
    return df.where(mark | ~any_passed)


def top_per_target(df: DataFrame, n: int) -> DataFrame:
    """The n best-scored rows of each code. Rows without a code are kept; they are never classified."""
    order = [F.col("score").desc_nulls_last(), F.col("target_rank").asc_nulls_last(), *map(F.col, IDENTITY)]
    number = F.row_number().over(Window.partitionBy("target_code").orderBy(*order))
    coded = df.where(F.col("target_code").isNotNull())
    best = coded.withColumn("_n", number).where(F.col("_n") <= n).drop("_n")
    return best.unionByName(df.where(F.col("target_code").isNull()))


def context_group(study: Column, dataset: Column, base: Column, text: Column, row_key: Column) -> Column:
    """Which rows belong together: same study and base name, same dataset and base name, same description, or
    none. Takes key forms. Fixed values: the key texts, since the id is a hash over them."""
    key = (F.when((study != "") & (base != ""), F.concat(F.lit("same_study_base::"), study, F.lit("::"), base))
           .when((dataset != "") & (base != ""), F.concat(F.lit("same_dataset_base::"), dataset, F.lit("::"), base))
           .when(F.length(text) >= MIN_DESCRIPTION, F.concat(F.lit("same_description::"), text))
           .otherwise(F.concat(F.lit("singleton::"), row_key)))
    return F.concat(F.lit("G_"), short_hash(key))


def with_context_group(df: DataFrame) -> DataFrame:
    forms = {"_study": key_form(F.col("study")), "_dataset": key_form(F.col("dataset_name")),
             "_base": base_name(F.col("name")), "_text": key_form(F.col("description"))}
    rows = df.withColumns(forms)
    return rows.withColumn("context_group", context_group(*map(F.col, forms), F.col("row_key"))).drop(*forms)


def load_pairs(df: DataFrame, settings: LabelSettings) -> DataFrame:
    """Checked, filtered and keyed pairs. Codes stay text in normal form; an empty code is null.

    Where the first targets are asked for and the rows have an `input_order`, `target_order` is the place of the first row
    of a code that passes the filters. With `top_n` there is none: rows then come in order of their code.
    """
    by_place = settings.first_targets is not None and settings.top_n is None and "input_order" in df.columns
    place = [F.col("input_order")] if by_place else []
    rows = ensure_columns(require_columns(df, REQUIRED), OPTIONAL).select(*REQUIRED, *OPTIONAL, *place)
    rows = keep_passed(rows)
    code = normalize_code(F.col("target_code"))
    rows = rows.withColumn("target_code", F.when(code != "", code))
    if settings.target_codes is not None:
        rows = with_codes(rows, "target_code", settings.target_codes)
    if by_place:
        first = rows.where("target_code IS NOT NULL").groupBy("target_code").agg(F.min("input_order").alias("target_order"))
        rows = rows.drop("input_order")
    rows = rows.withColumns({
        "score": to_number(F.col("score")),
        "target_rank": to_number(F.col("target_rank")),
        **{c: clean(F.col(c)) for c in IDENTITY if c != "target_code"},
    })
    if settings.top_n is not None:
        rows = top_per_target(rows, settings.top_n)
    numbers = [F.round(F.col(c) * _SCALE).try_cast("decimal(38,0)") for c in ("score", "target_rank")]
    rows = with_content_key(rows, IDENTITY, "row_key", [*numbers, F.col("passed"), F.col("pass_label")])
    rows = with_context_group(rows)
    return rows.join(first, "target_code", "left") if by_place else rows


def first_targets(df: DataFrame, n: int, order: Column | None = None) -> DataFrame:
    """Rows of the first n codes, by their smallest `order` (the code itself if none is given)."""
    first = F.min(F.col("target_code") if order is None else order).alias("first")
    codes = df.where(F.col("target_code").isNotNull()).groupBy("target_code").agg(first)
    return df.join(codes.orderBy("first", "target_code").limit(n), "target_code", "left_semi")
