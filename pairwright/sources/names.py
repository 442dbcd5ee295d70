"""Column names: the library's own, and the headers of the files it reads and writes."""

from __future__ import annotations

# File header -> column, for the target table.
TARGET_HEADERS = {
    "phecode": "target_code",
    "phenotype": "target_name",
    "category": "target_category",
}

# File header -> column, for the candidate table.
CANDIDATE_HEADERS = {
    "Variable accession": "accession",
    "Variable name": "name",
    "Variable description": "description",
    "Type": "type",
    "Dataset accession": "dataset_accession",
    "Dataset name": "dataset_name",
    "Study": "study",
    "Database": "database",
    "Form name": "form_name",
    "Table name": "table_name",
    "Visit": "visit",
    "Visit name": "visit_name",
    "Collection event": "collection_event",
}

# File header -> column, for what stage one adds to a pair.
RETRIEVAL_HEADERS = {
    "cosine_similarity": "score",
    "step1_rank": "target_rank",
    "step1_rank_within_constraint_group": "rank_in_group",
    "step1_pass": "passed",
    "step1_label": "pass_label",
    "max_similarity_for_phecode": "max_for_target",
    "constraint_scope": "scope",
    "constraint_group_col": "group_column",
    "constraint_group": "group",
    "max_similarity_for_phecode_group": "max_in_group",
    "delta": "delta",
    "adaptive_threshold": "threshold",
    "delta_method": "spread",
    "delta_scale": "scale",
    "min_candidates_per_group": "min_candidates",
    "max_candidates_per_group": "max_candidates",
    "n_variables_in_group_pool": "n_pool",
    "n_above_threshold_in_group": "n_above",
    "n_selected_in_group": "n_selected",
    "group_min_padded": "min_padded",
    "group_max_capped": "max_capped",
}

# File header -> column, for the two summaries.
SUMMARY_HEADERS = {
    "n_candidates": "n_candidates",
    "n_constraint_groups_with_candidates": "n_groups",
    "min_candidates_in_one_group": "min_in_one_group",
    "median_candidates_in_one_group": "median_in_one_group",
    "max_candidates_in_one_group": "max_in_one_group",
    "n_group_min_padded": "n_min_padded",
    "n_group_max_capped": "n_max_capped",
}

# File header -> column, for the label log.
LABEL_HEADERS = {
    "_row_id": "row_key",
    "step2_clinical_category": "label_category",
    "step2_relation_level": "label_relation",
    "step2_keep": "label_keep",
    "step2_priority": "label_priority",
    "step2_reason": "label_reason",
    "step2_status": "label_status",
    "step2_error": "label_error",
}

# File header -> column, for what the merge and the ranking add.
MERGE_HEADERS = {
    "context_group_id": "context_group",
    "step2_label": "label",
    "is_exact_diagnosis": "is_exact_diagnosis",
    "is_related_lab": "is_related_lab",
    "is_related_medication": "is_related_medication",
    "relation_rank": "relation_rank",
    "category_rank": "category_rank",
    "step2_rank": "final_rank",
}

ALL_HEADERS = {**TARGET_HEADERS, **CANDIDATE_HEADERS, **RETRIEVAL_HEADERS, **SUMMARY_HEADERS, **LABEL_HEADERS,
               **MERGE_HEADERS}

TARGET_COLUMNS = tuple(TARGET_HEADERS.values())
CANDIDATE_COLUMNS = tuple(CANDIDATE_HEADERS.values())
LABEL_COLUMNS = tuple(LABEL_HEADERS.values())[1:]


def header_of(column: str) -> str:
    """The file header of a column, or the name itself."""
    return {v: k for k, v in ALL_HEADERS.items()}.get(column, column)
