"""Whole-table column work: required, optional and cleaned columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.functions.text import blank_missing, clean, strip
from pairwright.settings import MISSING_TOKENS


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")
    return df


def ensure_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Add the columns that are not there, as empty text."""
    return df.withColumns({c: F.lit("") for c in columns if c not in df.columns})


def clean_columns(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = MISSING_TOKENS) -> DataFrame:
    """Missing tokens blanked, null as the empty string, stripped; absent columns added."""
    df = ensure_columns(df, columns)
    ready = {c: strip(blank_missing(F.coalesce(F.col(c).cast("string"), F.lit("")), tokens)) for c in columns}
    return df.withColumns(ready)


def fill_group(df: DataFrame, column: str, header: str, name: str = "group") -> DataFrame:
    """The group column, with `UNKNOWN_<HEADER>` where it is empty."""
    text = clean(F.col(column))
    return df.withColumn(name, F.when(text == "", F.lit(f"UNKNOWN_{header.upper()}")).otherwise(text))
