"""Text columns: trimming, key forms, base names, templates and short hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's idea of white space: Unicode white space plus the four separators U+001C to U+001F.
_SPACE = r"[\s\x{1c}-\x{1f}]"
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# The suffix words a base name loses, tried once each in this order.
SUFFIX_WORDS = ("visit", "v", "fu", "followup", "year", "yr", "month", "mo", "day")


def strip(text: Column) -> Column:
    """Drop white space at both ends; `trim` alone would only drop spaces."""
    return F.btrim(text, F.lit(_SPACES))


def clean(text: Column) -> Column:
    """Text of any value, null as the empty string, stripped."""
    return strip(F.coalesce(text.cast("string"), F.lit("")))


def blank_missing(text: Column, tokens: Sequence[str]) -> Column:
    """Read the cell texts that stand for a missing value as the empty string."""
    return F.when(text.isin(*tokens), F.lit("")).otherwise(text) if tokens else text


def squeeze(text: Column) -> Column:
    """Collapse each run of white space to one space and strip."""
    return strip(F.regexp_replace(text, rf"(?U){_SPACE}+", " "))


def key_form(text: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 as one space."""
    return F.trim(F.regexp_replace(F.lower(clean(text)), "[^a-z0-9]+", " "))


def base_name(name: Column) -> Column:
    """A variable name without its visit, wave or date suffixes."""
    out = F.regexp_replace(F.lower(clean(name)), "[^a-z0-9_]+", "_")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), r"\A_+|_+\z", "")
    for word in SUFFIX_WORDS:
        out = F.regexp_replace(out, rf"_?{word}_?[0-9]+\z", "")
    return F.regexp_replace(out, r"\A_+|_+\z", "")


def short_hash(text: Column, n: int = 10) -> Column:
    return F.substring(F.md5(text.cast("binary")), 1, n)


def template(parts: Sequence[tuple[str, str]]) -> Column:
    """`Label: value. Label: value.` over (label, column) pairs."""
    pieces = [F.concat(F.lit(f"{label}: "), clean(F.col(column)), F.lit(".")) for label, column in parts]
    return F.concat_ws(" ", *pieces)
