"""Replies read, checked and matched to the rows that were asked for.

A reply is one text per batch. Everything below works on one row per batch and fans out to the rows of the batch at the
end; a batch has at most `batch_size` rows, so the arrays stay small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright import settings as S
from pairwright.functions.labels import keep_of, priority_of, valid_category, valid_relation
from pairwright.functions.text import squeeze, strip
from pairwright.operators.requests import BATCH
from pairwright.settings import LabelSettings

NOT_JSON = "the reply is not JSON"
NO_LIST = "the field 'results' is not a list"
EMPTY_LIST = "the field 'results' is empty"
NOT_OBJECTS = "a result is not an object"
NO_REPLY = "no reply"


def unfence(text: Column) -> Column:
    """Without the code fence that models like to put around JSON."""
    text = strip(text)
    inner = strip(F.regexp_replace(text, r"(?i)\A```json", ""))
    inner = strip(F.regexp_replace(inner, r"\A```", ""))
    inner = strip(F.regexp_replace(inner, r"```\z", ""))
    return F.when(F.startswith(text, F.lit("```")), inner).otherwise(text)


def parse_replies(replies: DataFrame) -> DataFrame:
    """Adds `items` (row_id, category, relation, reason), null for a failed batch, and `reply_error`.

    Tried as it stands, then from the first `{` to the last `}`. A field that is absent takes its default; one that is
    JSON null reads as the text `None`.
    """
    text = unfence(F.col("reply"))
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    rows = replies.withColumn("_json", F.coalesce(F.try_parse_json(text), F.try_parse_json(braces)))
    rows = rows.withColumn("_list", F.expr("try_variant_get(_json, '$.results', 'array<variant>')"))
    whole = F.expr("forall(_list, x -> coalesce(startswith(schema_of_variant(x), 'OBJECT'), false))")
    error = (F.when(F.col("reply").isNull(), NO_REPLY)
             .when(F.col("_json").isNull(), NOT_JSON)
             .when(F.col("_list").isNull(), NO_LIST)
             .when(F.size("_list") == 0, EMPTY_LIST)
             .when(~whole, NOT_OBJECTS))
    if "error" in replies.columns:
        error = F.coalesce(F.when(F.col("reply").isNull(), F.col("error")), error)
    rows = rows.withColumn("reply_error", error)
    field = ("case when try_variant_get(x, '$.{f}', 'variant') is null then '{d}' "
             "when is_variant_null(try_variant_get(x, '$.{f}', 'variant')) then 'None' "
             "else coalesce(try_variant_get(x, '$.{f}', 'string'), '') end as {a}")
    fields = ", ".join(field.format(f=f, d=d, a=a) for f, d, a in (
        ("row_id", "", "row_id"), ("clinical_category", "unrelated", "category"),
        ("relation_level", "unrelated", "relation"), ("reason", "", "reason")))
    items = F.expr(f"transform(_list, x -> struct({fields}))")
    items = F.when(F.col("reply_error").isNull(), items)
    return rows.withColumn("items", items).drop("_json", "_list", "error")


def _checked(item: Column) -> Column:
    relation = valid_relation(F.lower(strip(item["relation"])))
    category = valid_category(F.lower(strip(item["category"])), relation)
    return F.struct(strip(item["row_id"]).alias("row_key"), category.alias("label_category"),
                    relation.alias("label_relation"), keep_of(relation).alias("label_keep"),
                    priority_of(relation).alias("label_priority"), squeeze(item["reason"]).alias("label_reason"))


def validate_items(parsed: DataFrame) -> DataFrame:
    """One row per item of a readable reply, normalised; `item_no` is its place in the reply."""
    rows = parsed.select(*BATCH, F.posexplode("items").alias("item_no", "item"))
    return rows.select(*BATCH, F.col("item_no").cast("bigint").alias("item_no"), _checked(F.col("item")).alias("r")
                       ).select(*BATCH, "item_no", "r.*")


def stray_items(requests: DataFrame, parsed: DataFrame) -> DataFrame:
    """Items whose id was not asked for in their batch: reported, never used."""
    rows = validate_items(parsed).join(requests.select(*BATCH, "row_keys"), list(BATCH), "left")
    return rows.where(~F.coalesce(F.array_contains("row_keys", F.col("row_key")), F.lit(False))).drop("row_keys")


def best_replies(replies: DataFrame) -> DataFrame:
    """One parsed reply per batch: a readable one before others, then the smallest by reply and error text."""
    known = replies.select(*BATCH, "reply", *[c for c in ("error",) if c in replies.columns])
    parsed = parse_replies(known)
    order = F.struct(F.col("reply_error").isNotNull(), F.coalesce("reply", F.lit("")), F.coalesce("reply_error", F.lit("")))
    best = F.min_by(F.struct("items", "reply_error", F.lit(1).alias("reply_no")), order)
    return parsed.groupBy(*BATCH).agg(best.alias("best")).select(*BATCH, "best.*")


def classify(requests: DataFrame, replies: DataFrame, settings: LabelSettings) -> DataFrame:
    """One result per requested row: the last matching item, or a fallback with its status.

    `replies` has (target_code, batch_no, reply) and optionally `error`; a batch without a reply has failed, and of
    several replies to a batch the best readable one counts.
    """
    asked = requests.select(*BATCH, "row_keys")
    parsed = asked.join(best_replies(replies), list(BATCH), "left")
    parsed = parsed.withColumn("reply_error", F.when(F.col("reply_no").isNull(), NO_REPLY).otherwise(F.col("reply_error")))
    checked = F.transform("items", _checked)
    rows = parsed.withColumn("items", checked).withColumn("row_key", F.explode("row_keys"))
    mine = F.filter("items", lambda item: item["row_key"] == F.col("row_key"))
    rows = rows.withColumn("hit", F.try_element_at(mine, F.lit(-1)))
    failed, found = F.col("reply_error").isNotNull(), F.col("hit").isNotNull()
    if settings.on_error == "raise":
        message = F.concat(F.lit("batch failed: "), "target_code", F.lit(": "), "reply_error")
        failed = F.when(failed, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))

    def pick(field: str, fallback: Column) -> Column:
        return F.when(found, F.col(f"hit.{field}")).otherwise(fallback).alias(field)

    status = F.when(failed, S.FAILED).when(found, S.OK).otherwise(S.MISSING_FROM_REPLY)
    reason = F.when(failed, F.concat(F.lit(S.REASON_FAILED), "reply_error")).otherwise(S.REASON_MISSING_FROM_REPLY)
    return rows.select(
        *BATCH, "row_key",
        pick("label_category", F.lit("unrelated")), pick("label_relation", F.lit("unrelated")),
        pick("label_keep", F.lit(False)), pick("label_priority", F.lit(S.LOWEST_PRIORITY)),
        pick("label_reason", reason), status.alias("label_status"),
        F.coalesce("reply_error", F.lit("")).alias("label_error"))


def ask(requests: DataFrame, load: Callable[[], Callable[[str], str]]) -> DataFrame:
    """Replies from a classifier: `load` runs once per task, then one call per request. A call that raises fails
    its batch only. Write the result before using it twice: a classifier need not repeat itself."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classifier = load()
        for frame in frames:
            answers = [_answer(classifier, text) for text in frame["request"]]
            yield frame[list(BATCH)].assign(reply=[a for a, _ in answers], error=[e for _, e in answers])

    return requests.select(*BATCH, "request").mapInPandas(
        run, "target_code string, batch_no bigint, reply string, error string")


def _answer(classifier: Callable[[str], str], text: str) -> tuple[str | None, str | None]:
    try:
        return classifier(text), None
    except Exception as error:  # noqa: BLE001 - any failure of the service is a failed batch
        return None, str(error)
