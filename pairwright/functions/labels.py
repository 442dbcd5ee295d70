"""Label columns: validation, derived label, flags and sort ranks."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairwright import settings as S


def lookup(value: Column, table: Mapping[str, int], default: int) -> Column:
    """Small constant dictionary lookup."""
    pairs = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))
    return F.coalesce(F.try_element_at(pairs, value), F.lit(default))


def valid_relation(text: Column) -> Column:
    return F.when(text.isin(*S.RELATION_RANKS), text).otherwise(F.lit("unrelated"))


def valid_category(text: Column, relation: Column) -> Column:
    """Unknown categories count as `other`; an unrelated pair has no category."""
    known = F.when(text.isin(*S.CATEGORY_RANKS), text).otherwise(F.lit("other"))
    return F.when(relation == "unrelated", F.lit("unrelated")).otherwise(known)


def priority_of(relation: Column) -> Column:
    return lookup(relation, S.RELATION_PRIORITIES, S.LOWEST_PRIORITY)


def keep_of(relation: Column) -> Column:
    return F.coalesce(relation.isin(*S.RELATION_PRIORITIES), F.lit(False))


def final_label(relation: Column, category: Column) -> Column:
    """Relation prefix plus category, or `unrelated`."""
    out = F.lit("unrelated")
    for name, prefix in S.LABEL_PREFIXES.items():
        out = F.when(relation == name, F.concat(F.lit(prefix), category)).otherwise(out)
    return out


def is_exact_diagnosis(relation: Column, category: Column) -> Column:
    return (category == "diagnosis") & (relation == "exact_same")


def is_related(kind: str, relation: Column, category: Column) -> Column:
    return (category == kind) & relation.isin("directly_related", "clinically_relevant")
