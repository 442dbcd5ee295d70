"""Numbers read from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column) -> Column:
    """A double, or null where the text is no number (or is NaN)."""
    number = value.try_cast("double")
    return F.when(F.isnan(number), F.lit(None).cast("double")).otherwise(number)
