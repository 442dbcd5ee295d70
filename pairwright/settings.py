"""Settings and fixed values. Nothing here touches Spark."""

from __future__ import annotations

from dataclasses import dataclass, field

# The label vocabularies and their sort ranks.
CATEGORY_RANKS = {
    "diagnosis": 1,
    "lab": 2,
    "medication": 3,
    "procedure": 4,
    "vital": 5,
    "imaging": 6,
    "symptom": 7,
    "lifestyle": 8,
    "survey": 9,
    "demographic": 10,
    "other": 50,
    "administrative": 98,
    "unrelated": 99,
}
RELATION_RANKS = {
    "exact_same": 1,
    "directly_related": 2,
    "clinically_relevant": 3,
    "unrelated": 99,
}
UNKNOWN_RANK = 99

# Relation -> priority, and the prefix of the final label.
RELATION_PRIORITIES = {"exact_same": 1, "directly_related": 2, "clinically_relevant": 3}
LOWEST_PRIORITY = 4
LABEL_PREFIXES = {"exact_same": "exact_", "directly_related": "related_", "clinically_relevant": "relevant_"}

# Label statuses.
OK = "ok"
MISSING_FROM_REPLY = "missing_from_llm_output"
FAILED = "llm_failed"
MISSING = "missing"
UNKNOWN = "unknown"

# The reasons written on rows that got no answer.
REASON_MISSING_FROM_REPLY = "Missing from LLM output; assigned unrelated fallback."
REASON_FAILED = "LLM failed after all retries; fallback assigned. Error: "
REASON_MISSING = "Missing classification; assigned unrelated fallback."

# The cell texts that a CSV reader in the pandas style takes for missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class RetrievalSettings:
    """Stage one: how candidates are grouped, thresholded, padded and capped."""

    group_column: str = "database"
    min_candidates: int = 10
    max_candidates: int = 100
    spread: str = "mad"
    scale: float = 3.0
    target_codes: tuple[str, ...] | None = None
    first_targets: int | None = None
    unit_vectors: bool = False  # bring supplied vectors to norm one
    missing_tokens: tuple[str, ...] = MISSING_TOKENS

    # Physical limits. A cell is the unit of work of one Python call: at most about `cell_rows` candidates
    # against at most about `cell_targets` targets, about `cell_values` vector elements on either side, and about
    # `cell_output` rows of output.
    # Groups above the limit are split over several cells.
    cell_rows: int = 65_536
    cell_targets: int = 32_768
    cell_values: int = 33_554_432
    cell_output: int = 16_777_216
    bins_per_unit: int = 2_048
    value_rows: int = 1_000_000
    broadcast_rows: int = 100_000
    broadcast_bytes: int = 67_108_864
    window_rows: int = 1_000_000

    def __post_init__(self) -> None:
        if self.spread not in ("mad", "sd"):
            raise ValueError(f"unsupported spread method: {self.spread!r}")
        if self.min_candidates < 0 or self.max_candidates < 1:
            raise ValueError("min_candidates must be >= 0 and max_candidates >= 1")
        if self.bins_per_unit & (self.bins_per_unit - 1):
            raise ValueError("bins_per_unit must be a power of two, so that bin edges are exact")


@dataclass(frozen=True)
class LabelSettings:
    """Stage two: which pairs are sent, in what batches, and how replies are read."""

    batch_size: int = 25
    batches_per_commit: int = 10_000
    target_codes: tuple[str, ...] | None = None
    first_targets: int | None = None
    top_n: int | None = None
    resume: bool = True
    retry_failed: bool = True
    on_error: str = "mark"
    fill_score: float | None = None
    window_rows: int = 1_000_000
    category_ranks: dict[str, int] = field(default_factory=lambda: dict(CATEGORY_RANKS))
    relation_ranks: dict[str, int] = field(default_factory=lambda: dict(RELATION_RANKS))

    def __post_init__(self) -> None:
        if self.on_error not in ("mark", "raise"):
            raise ValueError(f"on_error must be 'mark' or 'raise', not {self.on_error!r}")
        if self.batch_size < 1:
            raise ValueError("batch_size must be >= 1")
