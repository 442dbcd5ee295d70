"""Target codes: which are kept, and their one normal form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.text import clean

_WHOLE = r"\A[0-9]+\z"
_DECIMAL = r"\A[0-9]+\.[0-9]+\z"


def keep_code(code: Column) -> Column:
    """Whole numbers and numbers with exactly one decimal."""
    return clean(code).rlike(r"\A[0-9]+(\.[0-9])?\z")


def normalize_code(code: Column) -> Column:
    """`008` and `8.0` as `8`, `250.10` as `250.1`, other text as it is."""
    text = clean(code)
    short = F.regexp_replace(text, r"\A0+(?=[0-9])", "")
    trimmed = F.regexp_replace(F.regexp_replace(short, r"0+\z", ""), r"\.\z", "")
    return F.when(text.rlike(_WHOLE), short).when(text.rlike(_DECIMAL), trimmed).otherwise(text)


def with_codes(df: DataFrame, column: str, wanted: Iterable[str]) -> DataFrame:
    """Rows whose code is in a list of any length, both sides in normal form: one semi-join."""
    table = df.sparkSession.createDataFrame([(str(value),) for value in wanted], "wanted string")
    table = table.select(normalize_code(F.col("wanted")).alias("_wanted")).distinct()
    return df.join(table, normalize_code(F.col(column)) == F.col("_wanted"), "left_semi")


def in_codes(code: Column, wanted: Iterable[str]) -> Column:
    """Membership in a short list of codes, both sides in normal form."""
    options = [normalize_code(F.lit(str(value))) for value in wanted]
    return normalize_code(code).isin(*options) if options else F.lit(False)
