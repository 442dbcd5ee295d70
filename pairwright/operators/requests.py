"""Batches of pairs and the requests made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairwright.functions.text import clean
from pairwright.operators.ranking import descending_bins, row_number_within
from pairwright.settings import LabelSettings

BATCH = ("target_code", "batch_no")
_BINS = 2_048
#: Batches of one code that meet one copy of its header.
_BATCHES_PER_COPY = 1_000

# The fields of a candidate in a request, as (field, column).
REQUEST_FIELDS = (
    ("row_id", "row_key"),
    ("context_group_id", "context_group"),
    ("variable_accession", "accession"),
    ("variable_name", "name"),
    ("variable_description", "description"),
    ("type", "type"),
    ("study", "study"),
    ("database", "database"),
    ("dataset_accession", "dataset_accession"),
    ("dataset_name", "dataset_name"),
    ("form_name", "form_name"),
    ("table_name", "table_name"),
    ("visit", "visit"),
    ("visit_name", "visit_name"),
    ("collection_event", "collection_event"),
    ("cosine_similarity", "score"),
    ("step1_rank", "target_rank"),
    ("step1_label", "pass_label"),
)
CATEGORY_NOTES = {
    "diagnosis": "a disease or condition, as found, reported or coded",
    "lab": "a value measured in blood, urine, tissue or another sample",
    "medication": "a drug or other substance given or taken as treatment, its dose or use",
    "procedure": "an operation, intervention or device",
    "vital": "a bodily measure taken at the person, such as weight, pulse or blood pressure",
    "imaging": "a finding or measure from scans, X-rays, ultrasound or tracings",
    "symptom": "a complaint or sign, not yet a diagnosis",
    "lifestyle": "habits and exposures, such as smoking, food, alcohol or exercise",
    "survey": "an item or score of a questionnaire on health, mood or quality of life",
    "demographic": "who the person is: age, sex, origin, education, work",
    "administrative": "keys, dates, consent, form handling and the like",
    "other": "clinical, but none of these",
    "unrelated": "nothing clinical",
}
_NUMBERS = {"score": "double", "target_rank": "bigint"}

REQUEST_TEMPLATE = """Decide how each listed cohort variable relates to one target diagnosis.

Target code: {code}
Target name: {name}
Target category: {category}

Give every variable
- clinical_category, one of: {categories}.
{definitions}
- relation_level, one of: {relations}.
  exact_same: the variable records the diagnosis itself.
  directly_related: a standard measurement, medication or procedure for the diagnosis, but not the diagnosis.
  clinically_relevant: risk, complication or wider context only.
  unrelated: no clinical connection worth keeping.
- keep (true unless unrelated), priority (1 exact_same, 2 directly_related, 3 clinically_relevant, 4 unrelated);
- reason, a few words.

A laboratory value or a medication is never exact_same. Identifiers, dates and form data are administrative and as a
rule unrelated. Judge by the description first, then the name, then where the variable comes from. Variables with one
context_group_id need not get one answer. When in doubt choose the weaker relation.

Answer with JSON alone, in this form and with each row_id once:
{{"results": [{{"row_id": "...", "clinical_category": "...", "relation_level": "...", "keep": true, "priority": 1,
"reason": "..."}}]}}

Variables:
{variables}"""


def assign_batches(pending: DataFrame, settings: LabelSettings) -> DataFrame:
    """Adds `position` (best score first within the code) and `batch_no`. Rows without a code are left out."""
    score = F.col("score")
    order = [score.desc_nulls_last(), F.col("row_key")]
    last = F.lit(float("inf"))
    coarse = [descending_bins(score, _BINS)]
    fine = [F.coalesce(-score, last), F.substring("row_key", 1, 3)]
    rows = pending.where(F.col("target_code").isNotNull())
    rows = row_number_within(rows, ["target_code"], [coarse, fine], order, "position", settings.window_rows)
    return rows.withColumn("batch_no", F.floor((F.col("position") - 1) / settings.batch_size).cast("bigint"))


def target_headers(pending: DataFrame) -> DataFrame:
    """Name and category of a code, from its best-scored pending row, and how many rows are pending."""
    place = F.struct(F.coalesce(-F.col("score"), F.lit(float("inf"))), F.col("row_key"))
    head = F.min_by(F.struct("target_name", "target_category"), place)
    return pending.where(F.col("target_code").isNotNull()).groupBy("target_code").agg(
        head.alias("head"), F.count(F.lit(1)).alias("n_pending")).select("target_code", "head.*", "n_pending")


def build_requests(batched: DataFrame, headers: DataFrame, settings: LabelSettings,
                   template: str = REQUEST_TEMPLATE) -> DataFrame:
    """One row per batch: its row keys, the candidates as JSON and the request text.

    The header of a code is copied once for every so many of its batches, and batches meet the copies in turn, so a code
    that holds a third of all rows is spread like any other.
    """
    fields = [(F.col(c).cast(_NUMBERS[c]) if c in _NUMBERS else clean(F.col(c))).alias(name)
              for name, c in REQUEST_FIELDS]
    rows = batched.select(*BATCH, F.struct("position", "row_key", F.struct(*fields).alias("item")).alias("row"))
    grouped = rows.groupBy(*BATCH).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    payload = F.to_json(F.col("rows.item"), {"ignoreNullFields": "false"})
    requests = grouped.select(*BATCH, F.size("rows").cast("bigint").alias("n_rows"),
                              F.col("rows.row_key").alias("row_keys"), payload.alias("payload"))
    last = F.floor(F.col("n_pending") / (settings.batch_size * _BATCHES_PER_COPY)).cast("bigint")
    copies = headers.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("n_pending")
    requests = requests.withColumn("_copy", F.floor(F.col("batch_no") / _BATCHES_PER_COPY).cast("bigint"))
    requests = requests.join(copies, ["target_code", "_copy"]).drop("_copy")
    return requests.withColumn("request", _fill_template(template, settings))


def _fill_template(template: str, settings: LabelSettings) -> Column:
    values = {
        "code": F.col("target_code"), "name": F.col("target_name"), "category": F.col("target_category"),
        "variables": F.col("payload"),
        "categories": F.lit(", ".join(settings.category_ranks)),
        "relations": F.lit(", ".join(settings.relation_ranks)),
        "definitions": F.lit("\n".join(f"  {name}: {CATEGORY_NOTES[name]}." for name in settings.category_ranks if name in CATEGORY_NOTES)),
    }
    marks = {name: f"\x00{name}\x00" for name in values}
    pieces = template.format(**marks).split("\x00")
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


