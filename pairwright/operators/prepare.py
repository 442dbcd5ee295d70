"""Target and candidate tables made ready for retrieval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.functions.codes import keep_code, normalize_code, with_codes
from pairwright.functions.text import template
from pairwright.operators.columns import clean_columns, fill_group
from pairwright.operators.keys import with_content_key
from pairwright.settings import RetrievalSettings
from pairwright.sources.names import CANDIDATE_COLUMNS, TARGET_COLUMNS, header_of

# The text that is embedded, as (label, column).
TARGET_TEXT = (
    ("Phecode", "target_code"),
    ("Phenotype", "target_name"),
    ("Category", "target_category"),
)
CANDIDATE_TEXT = (
    ("Variable accession", "accession"),
    ("Variable name", "name"),
    ("Variable description", "description"),
    ("Variable type", "type"),
    ("Study accession", "study"),
    ("Database/Cohort", "database"),
    ("Dataset name", "dataset_name"),
    ("Table name", "table_name"),
    ("Visit", "visit"),
    ("Visit name", "visit_name"),
    ("Collection event", "collection_event"),
)


def _with_id(df: DataFrame, identity: Sequence[str], name: str) -> DataFrame:
    """The table's own id, else the position in its file, else a key from the content."""
    if name in df.columns:
        return df
    if "input_order" in df.columns:
        return df.withColumn(name, F.col("input_order"))
    return with_content_key(df, identity, name)


def prepare_targets(df: DataFrame, settings: RetrievalSettings) -> DataFrame:
    """Cleaned targets with normal codes, their text and a `target_id`."""
    rows = clean_columns(df, TARGET_COLUMNS, settings.missing_tokens)
    rows = rows.where(keep_code(F.col("target_code")))
    rows = rows.withColumn("target_code", normalize_code(F.col("target_code")))
    if settings.target_codes is not None:
        rows = with_codes(rows, "target_code", settings.target_codes)
    rows = _with_id(rows, TARGET_COLUMNS, "target_id")
    rows = rows.withColumn("target_text", template(TARGET_TEXT))
    if settings.first_targets is not None:
        rows = first_rows(rows, settings.first_targets)
    return rows


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows of the file, or by id where the table has no order."""
    return df.orderBy("target_id").limit(n)


def prepare_candidates(df: DataFrame, settings: RetrievalSettings) -> DataFrame:
    """Cleaned candidates with their group, their text and a `cand_id`."""
    if settings.group_column not in CANDIDATE_COLUMNS and settings.group_column not in df.columns:
        raise ValueError(f"group column {settings.group_column!r} is not in the table: {df.columns}")
    rows = clean_columns(df, CANDIDATE_COLUMNS, settings.missing_tokens)
    rows = fill_group(rows, settings.group_column, header_of(settings.group_column))
    rows = rows.withColumn(settings.group_column, F.col("group"))
    rows = _with_id(rows, CANDIDATE_COLUMNS, "cand_id")
    return rows.withColumn("cand_text", template(CANDIDATE_TEXT))
