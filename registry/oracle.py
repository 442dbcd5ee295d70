"""The same queries in SQL for DuckDB, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from pairwright.operators.requests import CATEGORY_NOTES, REQUEST_TEMPLATE
from pairwright.settings import CATEGORY_RANKS, RELATION_RANKS
from registry import fragments as frag

# Python's white space as a character class.
_WS = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
_TOKENS = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', "
           "'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")
CATEGORIES = ("'diagnosis', 'lab', 'medication', 'procedure', 'vital', 'imaging', 'symptom', 'lifestyle', 'survey', "
              "'demographic', 'administrative', 'other', 'unrelated'")
RELATIONS = "'exact_same', 'directly_related', 'clinically_relevant', 'unrelated'"
_KEPT = "'exact_same', 'directly_related', 'clinically_relevant'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def clean(x: str) -> str:
    return strip(f"coalesce(CAST({x} AS VARCHAR), '')")


def cell(x: str) -> str:
    return strip(f"CASE WHEN coalesce({x}, '') IN ({_TOKENS}) THEN '' ELSE {x} END")


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def key_form(x: str) -> str:
    return f"trim(regexp_replace(lower({clean(x)}), '[^a-z0-9]+', ' ', 'g'))"


def code(x: str) -> str:
    s = clean(x)
    short = f"regexp_replace({s}, '^0+([0-9])', '\\1')"
    return (f"CASE WHEN regexp_full_match({s}, '[0-9]+') THEN {short} "
            f"WHEN regexp_full_match({s}, '[0-9]+\\.[0-9]+') "
            f"THEN regexp_replace(regexp_replace({short}, '0+$', ''), '\\.$', '') ELSE {s} END")


def keep_code(x: str) -> str:
    return f"regexp_full_match({clean(x)}, '[0-9]+(\\.[0-9])?')"


def base_name(x: str) -> str:
    out = f"regexp_replace(lower({clean(x)}), '[^a-z0-9_]+', '_', 'g')"
    out = f"trim(regexp_replace({out}, '_+', '_', 'g'), '_')"
    for word in ("visit", "v", "fu", "followup", "year", "yr", "month", "mo", "day"):
        out = f"regexp_replace({out}, '_?{word}_?[0-9]+$', '')"
    return f"trim({out}, '_')"


def relation(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN {s} IN ({RELATIONS}) THEN {s} ELSE 'unrelated' END"


def category(x: str, rel: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN {rel} = 'unrelated' THEN 'unrelated' WHEN {s} IN ({CATEGORIES}) THEN {s} ELSE 'other' END"


def priority(rel: str) -> str:
    return (f"CASE {rel} WHEN 'exact_same' THEN 1 WHEN 'directly_related' THEN 2 WHEN 'clinically_relevant' THEN 3 "
            "ELSE 4 END")


def label(rel: str, cat: str) -> str:
    return (f"CASE {rel} WHEN 'exact_same' THEN 'exact_' || {cat} WHEN 'directly_related' THEN 'related_' || {cat} "
            f"WHEN 'clinically_relevant' THEN 'relevant_' || {cat} ELSE 'unrelated' END")


def relation_rank(rel: str) -> str:
    return (f"CASE {rel} WHEN 'exact_same' THEN 1 WHEN 'directly_related' THEN 2 WHEN 'clinically_relevant' THEN 3 "
            "ELSE 99 END")


def category_rank(cat: str) -> str:
    names = ("diagnosis", "lab", "medication", "procedure", "vital", "imaging", "symptom", "lifestyle", "survey",
             "demographic")
    cases = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(names, 1))
    return f"CASE {cat} {cases} WHEN 'other' THEN 50 WHEN 'administrative' THEN 98 ELSE 99 END"


# --- stage one ------------------------------------------------------------------------------------------------------

RAW_T, RAW_C, RAW_P = frag.RAW_TARGETS, frag.RAW_CANDIDATES, frag.RAW_PAIRS

TARGETS = f"""
raw_t AS ({RAW_T}),
targets AS (SELECT target_id, {code(cell('target_code'))} AS target_code, {cell('target_name')} AS target_name,
                   {cell('target_category')} AS target_category
            FROM raw_t WHERE {keep_code(cell('target_code'))}),
targets_text AS (SELECT *, 'Phecode: ' || target_code || '. Phenotype: ' || target_name || '. Category: '
                        || target_category || '.' AS target_text FROM targets)
"""

_CAND = ("accession", "name", "description", "type", "dataset_accession", "dataset_name", "study")
_EMPTY = ("form_name", "table_name", "visit", "visit_name", "collection_event")
CANDIDATES = f"""
raw_c AS ({RAW_C}),
cleaned AS (SELECT cand_id, {', '.join(f'{cell(c)} AS {c}' for c in _CAND)}, {cell('"database"')} AS db,
                   {', '.join(f"'' AS {c}" for c in _EMPTY)} FROM raw_c),
candidates AS (SELECT *, CASE WHEN db = '' THEN 'UNKNOWN_DATABASE' ELSE db END AS "database" FROM cleaned),
candidates_text AS (SELECT *, 'Variable accession: ' || accession || '. Variable name: ' || name
    || '. Variable description: ' || description || '. Variable type: ' || type || '. Study accession: ' || study
    || '. Database/Cohort: ' || "database" || '. Dataset name: ' || dataset_name || '. Table name: ' || table_name
    || '. Visit: ' || visit || '. Visit name: ' || visit_name || '. Collection event: ' || collection_event || '.'
    AS cand_text FROM candidates)
"""


def stats(spread: str) -> str:
    """Scores of all pairs, then one row per (target, group)."""
    if spread == "mad":
        dev = """dev AS (SELECT s.target_id, s.grp, 3.0::DOUBLE * median(abs(s.score - g.md)) AS delta
                 FROM scored s JOIN pool g USING (target_id, grp) GROUP BY ALL)"""
    else:
        dev = """dev AS (SELECT target_id, grp, 3.0::DOUBLE * stddev_pop(score) AS delta FROM scored GROUP BY ALL)"""
    return f"""
scored AS (SELECT a.vec_id AS target_id, b.vec_id AS cand_id, CAST(b.label AS VARCHAR) AS grp,
                  list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS score
           FROM embeddings a, embeddings b),
pool AS (SELECT target_id, grp, count(*) AS n_pool, max(score) AS mx, median(score) AS md FROM scored GROUP BY ALL),
{dev},
limits AS (SELECT p.*, d.delta, p.mx - d.delta AS threshold FROM pool p JOIN dev d USING (target_id, grp)),
above AS (SELECT s.target_id, s.grp, count(*) AS n_above FROM scored s JOIN limits l USING (target_id, grp)
          WHERE s.score >= l.threshold GROUP BY ALL),
full_stats AS (SELECT l.*, a.n_above, least(greatest(a.n_above, least(10, l.n_pool)), 30) AS k,
                      CASE WHEN a.n_above < 10 THEN 1 ELSE 0 END AS min_padded,
                      CASE WHEN greatest(a.n_above, least(10, l.n_pool)) > 30 THEN 1 ELSE 0 END AS max_capped
               FROM limits l JOIN above a USING (target_id, grp))"""


def picked(spread: str) -> str:
    return stats(spread) + """,
ordered AS (SELECT *, row_number() OVER (PARTITION BY target_id, grp ORDER BY score DESC, cand_id) AS rank_in_group
            FROM scored),
kept AS (SELECT o.*, f.n_pool, f.n_above, f.mx, f.delta, f.threshold, f.k, f.min_padded, f.max_capped
         FROM ordered o JOIN full_stats f USING (target_id, grp) WHERE o.rank_in_group <= f.k),
picked AS (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY score DESC, grp, rank_in_group) AS target_rank,
                  max(mx) OVER (PARTITION BY target_id) AS max_for_target FROM kept)"""


SELECT_COLUMNS = """target_id, cand_id, grp AS "group", round(score, 6) AS score, rank_in_group, n_pool, n_above,
    round(mx, 6) AS max_in_group, round(delta, 6) AS delta, round(threshold, 6) AS threshold, k AS n_selected,
    min_padded, max_capped"""

WIDE = picked("mad") + """,
wide AS (SELECT k.*, CAST(k.target_id AS VARCHAR) AS target_code, p.p_name AS target_name, p.p_type AS target_category,
                d.text AS description, d.source AS study, d.lang AS "database"
         FROM picked k LEFT JOIN part p ON p.p_partkey = k.target_id LEFT JOIN documents d ON d.doc_id = k.cand_id)"""

SUMMARY = WIDE + """,
per_group AS (SELECT target_code, grp, count(*) AS n, max(max_for_target) AS max_for_target,
                     sum(min_padded) AS pads, sum(max_capped) AS caps FROM wide GROUP BY ALL),
per_code AS (SELECT target_code, CAST(sum(n) AS BIGINT) AS n_candidates, count(*) AS n_groups, min(n) AS lo,
                    median(n) AS md, max(n) AS hi, max(max_for_target) AS max_for_target,
                    CAST(sum(pads) AS BIGINT) AS pads, CAST(sum(caps) AS BIGINT) AS caps FROM per_group GROUP BY ALL),
by_target AS (SELECT CAST(p.p_partkey AS VARCHAR) AS target_code, p.p_name AS target_name,
                     p.p_type AS target_category, coalesce(c.n_candidates, 0) AS n_candidates,
                     coalesce(c.n_groups, 0) AS n_groups, c.lo AS min_in_one_group, c.md AS median_in_one_group,
                     c.hi AS max_in_one_group, round(c.max_for_target, 6) AS max_for_target,
                     CASE WHEN c.n_groups > 0 THEN 'phecode_Database' END AS scope,
                     CASE WHEN c.n_groups > 0 THEN 'Database' END AS group_column,
                     CASE WHEN c.n_groups > 0 THEN 10 END AS min_candidates,
                     CASE WHEN c.n_groups > 0 THEN 30 END AS max_candidates,
                     c.pads AS n_min_padded, c.caps AS n_max_capped
              FROM part p LEFT JOIN per_code c ON c.target_code = CAST(p.p_partkey AS VARCHAR)),
by_group AS (SELECT target_code, target_name, target_category, 'Database' AS group_column, grp AS "group",
                    count(*) AS n_candidates, round(max(mx), 6) AS max_in_group,
                    round(max(threshold), 6) AS threshold, round(max(delta), 6) AS delta, max(n_pool) AS n_pool,
                    max(n_above) AS n_above, max(k) AS n_selected, max(min_padded) AS min_padded,
                    max(max_capped) AS max_capped, 10 AS min_candidates, 30 AS max_candidates
             FROM wide GROUP BY ALL)"""

_WANTED = "('7', '10', '12', '250.1')"

# --- stage two ------------------------------------------------------------------------------------------------------

_IDENTITY = ("target_code", "target_name", "target_category", "accession", "name", "description", "type",
             "dataset_accession", "dataset_name", "study", "database", "form_name", "table_name", "visit",
             "visit_name", "collection_event")
_GIVEN = ("target_name", "target_category", "accession", "name", "description", "type", "study", "dataset_name")


def _piece(name: str) -> str:
    return f"length({name}) || ':' || {name}"


_SHA = "sha256(" + " || ".join(
    _piece("coalesce(target_code, '')" if c == "target_code" else c if c in _GIVEN else "''") for c in _IDENTITY) + ")"

_TEXTS = ("CAST(CAST(round(score * 1e9) AS BIGINT) AS VARCHAR)", "CAST(CAST(round(target_rank * 1e9) AS BIGINT) AS VARCHAR)",
          "passed", "pass_label")
_VARIANT = " || ".join(f"length(coalesce({t}, '')) || ':' || coalesce({t}, '')" for t in _TEXTS)


def pairs(top_n: int | None = None) -> str:
    best = "" if top_n is None else f"""
    QUALIFY target_code IS NULL OR row_number() OVER (PARTITION BY target_code
        ORDER BY score DESC NULLS LAST, target_rank, accession) <= {top_n}"""
    return f"""
raw_p AS ({RAW_P}),
passed_p AS (SELECT * FROM raw_p WHERE lower(passed) IN ('true', '1', '1.0', 'yes')
             OR NOT (SELECT bool_or(lower(passed) IN ('true', '1', '1.0', 'yes')) FROM raw_p)),
typed AS (SELECT nullif({code('target_code')}, '') AS target_code, {', '.join(f'{clean(c)} AS {c}' for c in _GIVEN)},
                 TRY_CAST(score AS DOUBLE) AS score, TRY_CAST(target_rank AS DOUBLE) AS target_rank, passed, pass_label
          FROM passed_p),
best_p AS (SELECT * FROM typed{best}),
pairs AS (SELECT *, sha256({_SHA} || ':' || sha256({_VARIANT}) || ':1') AS row_key FROM best_p),
grouped_p AS (SELECT *, 'G_' || substr(md5(CASE
        WHEN {key_form('study')} <> '' AND {base_name('name')} <> ''
            THEN 'same_study_base::' || {key_form('study')} || '::' || {base_name('name')}
        WHEN {key_form('dataset_name')} <> '' AND {base_name('name')} <> ''
            THEN 'same_dataset_base::' || {key_form('dataset_name')} || '::' || {base_name('name')}
        WHEN length({key_form('description')}) >= 12 THEN 'same_description::' || {key_form('description')}
        ELSE 'singleton::' || row_key END), 1, 10) AS context_group FROM pairs)"""


BATCHED = pairs() + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY target_code ORDER BY score DESC NULLS LAST, row_key) AS position
           FROM grouped_p WHERE target_code IS NOT NULL),
batched AS (SELECT *, (position - 1) // 25 AS batch_no FROM placed),
heads AS (SELECT target_code, target_name AS head_name, target_category AS head_category FROM placed WHERE position = 1)
"""

ANSWERS = BATCHED + f""",
answers AS (SELECT b.*, l.quality, l.toxic, CAST(substr(b.accession, 4) AS BIGINT) AS doc_id,
                   {frag.REPLY_KIND} AS kind,
                   row_number() OVER (PARTITION BY target_code, batch_no ORDER BY position) AS in_batch
            FROM batched b LEFT JOIN labels l ON l.doc_id = CAST(substr(b.accession, 4) AS BIGINT)),
said AS (SELECT *, {relation(frag.ANSWER_RELATION)} AS rel, {strip(frag.ANSWER_CATEGORY)} AS cat_text,
                CASE WHEN kind = 3 THEN 'the reply is not JSON' WHEN kind IN (5, 6) THEN
                     'the field ''results'' is not a list'
                     WHEN kind = 4 OR (kind = 7 AND n_in_batch = 1) THEN 'the field ''results'' is empty'
                END AS failure
         FROM (SELECT *, count(*) OVER (PARTITION BY target_code, batch_no) AS n_in_batch FROM answers)),
judged AS (SELECT *, {category('cat_text', 'rel')} AS cat,
                  CASE WHEN failure IS NOT NULL THEN 'llm_failed' WHEN kind = 7 AND in_batch = 1
                       THEN 'missing_from_llm_output' ELSE 'ok' END AS status FROM said),
results AS (SELECT target_code, batch_no, row_key,
                   CASE WHEN status = 'ok' THEN cat ELSE 'unrelated' END AS label_category,
                   CASE WHEN status = 'ok' THEN rel ELSE 'unrelated' END AS label_relation,
                   status = 'ok' AND rel IN ({_KEPT}) AS label_keep,
                   CASE WHEN status = 'ok' THEN {priority('rel')} ELSE 4 END AS label_priority,
                   CASE status WHEN 'ok' THEN 'doc ' || doc_id
                        WHEN 'llm_failed' THEN 'LLM failed after all retries; fallback assigned. Error: ' || failure
                        ELSE 'Missing from LLM output; assigned unrelated fallback.' END AS label_reason,
                   status AS label_status, coalesce(failure, '') AS label_error
            FROM judged)"""

MERGED = ANSWERS + f""",
joined AS (SELECT p.*, coalesce(r.label_category, 'unrelated') AS label_category,
                  coalesce(r.label_relation, 'unrelated') AS label_relation,
                  coalesce(r.label_keep, false) AS label_keep, coalesce(r.label_priority, 4) AS label_priority,
                  coalesce(r.label_reason, 'Missing classification; assigned unrelated fallback.') AS label_reason,
                  coalesce(r.label_status, 'missing') AS label_status, coalesce(r.label_error, '') AS label_error
           FROM grouped_p p LEFT JOIN results r USING (row_key)),
merged AS (SELECT *, {label('label_relation', 'label_category')} AS label,
                  label_category = 'diagnosis' AND label_relation = 'exact_same' AS is_exact_diagnosis,
                  label_category = 'lab' AND label_relation IN ('directly_related', 'clinically_relevant')
                      AS is_related_lab,
                  label_category = 'medication' AND label_relation IN ('directly_related', 'clinically_relevant')
                      AS is_related_medication,
                  {relation_rank('label_relation')} AS relation_rank, {category_rank('label_category')} AS category_rank
           FROM joined),
ranked AS (SELECT *, CASE WHEN target_code IS NOT NULL THEN row_number() OVER (PARTITION BY target_code
               ORDER BY label_priority, relation_rank, category_rank, score DESC NULLS LAST, target_rank, row_key)
               END AS final_rank FROM merged)"""

#: After a second run over what failed or was missing in the first, answered soundly.
AGAIN = MERGED.replace(ANSWERS, ANSWERS + f""",
again AS (SELECT row_key, cat AS label_category, rel AS label_relation, rel IN ({_KEPT}) AS label_keep,
                 {priority('rel')} AS label_priority, 'doc ' || doc_id AS label_reason, 'ok' AS label_status, '' AS label_error,
                 CAST(CASE WHEN status = 'ok' THEN 0 ELSE 1 END AS BIGINT) AS run_seq FROM judged)""").replace(
    "LEFT JOIN results r", "LEFT JOIN again r")

_RESULT = ("target_code, batch_no, row_key, label_category, label_relation, label_keep, label_priority, label_reason, "
           "label_status, label_error")
_DOC_LABELS = "FROM documents d LEFT JOIN labels l USING (doc_id)"
_CAT, _REL = f"lower(trim({frag.ANSWER_CATEGORY}))", f"lower(trim({frag.ANSWER_RELATION}))"
_LATEST = """
log AS (SELECT CAST(user_id AS VARCHAR) AS row_key, CASE WHEN event_type = 'error' THEN 'llm_failed' ELSE 'ok' END
               AS label_status, value, event_id, ts FROM events),
latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY row_key ORDER BY ts DESC, event_id DESC) = 1)"""


def _counts(dimensions: tuple[str, ...], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({e} AS VARCHAR) AS value, count(*) AS n FROM {source} GROUP BY ALL"
        for d, e in ((d, '"database"' if d == "group" else d) for d in dimensions))


def _request_head() -> str:
    """The fixed wording with the values of a batch in place, as one SQL expression."""
    text = lambda value: "'" + value.replace("'", "''") + "'"
    notes = "\n".join(f"  {name}: {CATEGORY_NOTES[name]}." for name in CATEGORY_RANKS if name in CATEGORY_NOTES)
    values = {"code": "target_code", "name": "head_name", "category": "head_category", "variables": "''",
              "categories": text(", ".join(CATEGORY_RANKS)), "relations": text(", ".join(RELATION_RANKS)), "definitions": text(notes)}
    parts = REQUEST_TEMPLATE.format(**{name: f"\x00{name}\x00" for name in values}).split("\x00")
    return " || ".join(values[p] if k % 2 else text(p) for k, p in enumerate(parts))


ORACLE: dict[str, str] = {
    "targets": f"WITH {TARGETS} SELECT * FROM targets_text",
    "candidates": f"""WITH {CANDIDATES} SELECT cand_id, "database" AS "group", {', '.join(_CAND)}, "database",
        {', '.join(_EMPTY)}, md5(cand_text) AS text_md5 FROM candidates_text""",
    "clean_columns": f"""WITH raw_t AS ({RAW_T}) SELECT target_id, {cell('target_code')} AS target_code,
        {cell('target_name')} AS target_name, {cell('target_category')} AS target_category, '' AS visit FROM raw_t""",
    "normalize_code": f"WITH raw_t AS ({RAW_T}) SELECT target_id, {code('target_code')} AS code FROM raw_t",
    "code_filter": f"WITH raw_t AS ({RAW_T}) SELECT target_id FROM raw_t WHERE {keep_code('target_code')}",
    "allow_list": f"""WITH raw_t AS ({RAW_T}), c AS (SELECT target_id, {code('target_code')} AS code FROM raw_t)
        SELECT * FROM c WHERE code IN {_WANTED}""",
    "first_rows": f"WITH {TARGETS} SELECT target_id, target_code FROM targets ORDER BY target_id LIMIT 25",
    "group_fill": f"""WITH {CANDIDATES} SELECT "database" AS "group", count(*) AS n FROM candidates GROUP BY ALL""",
    "render_text": f"""WITH {TARGETS}, {CANDIDATES} SELECT 't' || target_id AS id, target_text AS text FROM targets_text
        UNION ALL SELECT 'c' || cand_id, cand_text FROM candidates_text""",
    "embed_norm": r"""SELECT doc_id, CAST(256 AS BIGINT) AS width,
        CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM documents""",
    "pair_cosine": """SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
        / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]))
           * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS score
        FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "similarity_all_pairs": f"""WITH {stats('mad')} SELECT target_id, count(*) AS n_scores,
        round(max(score), 6) AS best_score FROM scored GROUP BY ALL""",
    **{f"spread_{m}": f"""WITH {stats(m)} SELECT target_id, grp AS "group", n_pool, round(mx, 6) AS max_in_group,
        round(delta, 6) AS delta, round(threshold, 6) AS threshold, n_above FROM full_stats""" for m in ("mad", "sd")},
    "adaptive_select": f"WITH {picked('mad')} SELECT {SELECT_COLUMNS} FROM picked",
    "adaptive_select_sd": f"WITH {picked('sd')} SELECT {SELECT_COLUMNS} FROM picked",
    "global_rank": f"""WITH {picked('mad')} SELECT target_id, cand_id, grp AS "group", rank_in_group, target_rank,
        round(max_for_target, 6) AS max_for_target FROM picked""",
    "retrieve": f"""WITH {WIDE} SELECT {SELECT_COLUMNS}, target_rank, round(max_for_target, 6) AS max_for_target,
        target_code, target_name, target_category, length(description) AS description, study, "database", 1 AS passed,
        'not_hard_negative' AS pass_label, 'phecode_Database' AS scope, 'Database' AS group_column, 'mad' AS spread,
        3.0::DOUBLE AS scale, 10 AS min_candidates, 30 AS max_candidates FROM wide""",
    "target_summary": f"""WITH {SUMMARY} SELECT * REPLACE (CAST(min_in_one_group AS DOUBLE) AS min_in_one_group,
        CAST(max_in_one_group AS DOUBLE) AS max_in_one_group, CAST(min_candidates AS DOUBLE) AS min_candidates,
        CAST(max_candidates AS DOUBLE) AS max_candidates, CAST(n_min_padded AS DOUBLE) AS n_min_padded,
        CAST(n_max_capped AS DOUBLE) AS n_max_capped) FROM by_target""",
    "group_summary": f"WITH {SUMMARY} SELECT * FROM by_group",
    "count_describe": f"""WITH {SUMMARY} SELECT count(*) AS count, round(avg(n_candidates), 6) AS mean,
        round(stddev_samp(n_candidates), 6) AS std, CAST(min(n_candidates) AS DOUBLE) AS min,
        round(quantile_cont(n_candidates, 0.25), 6) AS p25, round(quantile_cont(n_candidates, 0.5), 6) AS p50,
        round(quantile_cont(n_candidates, 0.75), 6) AS p75, CAST(max(n_candidates) AS DOUBLE) AS max FROM by_target""",
    "count_quantiles": f"""WITH {SUMMARY}, qs AS (SELECT unnest([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]
        ::DOUBLE[]) AS quantile, unnest(quantile_cont(n_candidates, [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0]))
        AS value FROM by_group) SELECT quantile, round(value, 6) AS value FROM qs""",
    "count_buckets": f"""WITH {SUMMARY} SELECT {', '.join(
        f'count(*) FILTER (n_candidates > {n}) AS over_{n}' for n in (20, 50, 100, 200))} FROM by_target""",
    "group_buckets": f"""WITH {SUMMARY} SELECT count(*) FILTER (n_candidates = 10) AS at_min,
        count(*) FILTER (n_candidates >= 30) AS at_max FROM by_group""",
    "top_targets": f"""WITH {SUMMARY} SELECT target_code, n_candidates FROM by_target
        ORDER BY n_candidates DESC, target_code LIMIT 20""",
    "top_groups": f"""WITH {SUMMARY} SELECT target_code, "group", n_candidates FROM by_group
        ORDER BY n_candidates DESC, target_code, "group" LIMIT 20""",
    "inspect_top": f"""WITH {WIDE} SELECT target_code, target_rank, cand_id, grp AS "group", rank_in_group,
        round(score, 6) AS score FROM wide WHERE target_code IN {_WANTED} AND target_rank <= 20""",
    "inspect_by_group": f"""WITH {WIDE} SELECT target_code, grp AS "group", rank_in_group, cand_id,
        round(score, 6) AS score FROM wide WHERE target_code IN {_WANTED} AND rank_in_group <= 10""",
    "value_counts": f"WITH {CANDIDATES} " + _counts(("study", "group"), "candidates"),
    "load_candidates": f"""WITH {pairs()} SELECT target_code, target_name, target_category, accession, name,
        md5(description) AS description, type, study, '' AS dataset_accession, dataset_name, '' AS "database",
        '' AS form_name, '' AS table_name, '' AS visit, '' AS visit_name, '' AS collection_event, score, target_rank,
        passed, pass_label, row_key, context_group FROM grouped_p""",
    "coerce_numeric": """SELECT c_custkey, c_acctbal AS balance, TRY_CAST(c_mktsegment AS DOUBLE) AS segment,
        CAST(NULL AS DOUBLE) AS not_a_number FROM customer""",
    "row_key": f"WITH {pairs()} SELECT accession, row_key FROM pairs",
    "context_group": f"""WITH {pairs()} SELECT row_key, context_group, substr(md5(description), 1, 10) AS text_hash
        FROM grouped_p""",
    "norm_key": f"""SELECT doc_id, md5({key_form('text')}) AS key_md5, md5({squeeze('text')}) AS squeezed_md5,
        length({clean('text')}) AS n FROM documents""",
    "base_name": f"""WITH n AS (SELECT p_partkey, p_name || CASE p_size % 6 WHEN 0 THEN '_visit_2' WHEN 1 THEN 'v3'
        WHEN 2 THEN ' Yr 1' WHEN 3 THEN '_day_3_visit_2' WHEN 4 THEN '_FU_12_' ELSE '' END AS name FROM part)
        SELECT p_partkey, {base_name('name')} AS base FROM n""",
    "pass_filter": f"WITH {pairs()} SELECT accession FROM passed_p",
    "topn_per_target": f"WITH {pairs(15)} SELECT target_code, accession, round(score, 6) AS score FROM pairs",
    "first_n_targets": f"""WITH {pairs()}, firsts AS (SELECT target_code, min(target_rank) AS first FROM pairs
        WHERE target_code IS NOT NULL GROUP BY ALL ORDER BY first, target_code LIMIT 5)
        SELECT target_code, count(*) AS n FROM pairs JOIN firsts USING (target_code) GROUP BY ALL""",
    "first_targets_by_place": f"""WITH {pairs()}, firsts AS (
            SELECT target_code, min(CAST(substr(accession, 4) AS BIGINT)) AS first FROM pairs
            WHERE target_code IS NOT NULL GROUP BY ALL ORDER BY first, target_code LIMIT 3)
        SELECT target_code, CAST(count(*) AS BIGINT) AS n FROM pairs JOIN firsts USING (target_code) GROUP BY ALL""",
    "request_head": f"""WITH {BATCHED} SELECT DISTINCT target_code, batch_no, md5({_request_head()}) AS head_md5
        FROM batched JOIN heads USING (target_code)""",
    "assign_batches": f"WITH {BATCHED} SELECT target_code, row_key, position, batch_no FROM batched",
    "build_requests": f"""WITH {BATCHED} SELECT target_code, batch_no, count(*) AS n_rows,
        string_agg(row_key, ',' ORDER BY position) AS row_keys, max(head_name) AS target_name,
        max(head_category) AS target_category FROM batched JOIN heads USING (target_code)
        GROUP BY target_code, batch_no""",
    "request_text": f"""WITH {BATCHED} SELECT target_code, row_key AS row_id, context_group AS context_group_id,
        accession AS variable_accession, name AS variable_name, md5(description) AS variable_description, type, study,
        '' AS "database", '' AS dataset_accession, dataset_name, '' AS form_name, '' AS table_name, '' AS visit,
        '' AS visit_name, '' AS collection_event, round(score, 6) AS cosine_similarity, target_rank AS step1_rank,
        pass_label AS step1_label FROM batched""",
    "parse_replies": f"""WITH {ANSWERS} SELECT target_code, batch_no,
        count(*) FILTER (status = 'ok') AS n_items FROM judged GROUP BY ALL""",
    "reply_status": f"""WITH {ANSWERS}, b AS (SELECT target_code, batch_no, max(failure) AS reply_error FROM judged
        GROUP BY ALL) SELECT reply_error, count(*) AS n FROM b GROUP BY ALL""",
    "validate_items": f"""WITH {ANSWERS} SELECT target_code, batch_no, row_key, label_category, label_relation,
        label_keep, label_priority, label_reason FROM results WHERE label_status = 'ok'""",
    "stray_items": f"""WITH {ANSWERS} SELECT target_code, batch_no + 1 AS batch_no, row_key FROM judged
        WHERE status = 'ok'""",
    "missing_fallback": f"WITH {ANSWERS} SELECT {_RESULT} FROM results WHERE label_status = 'missing_from_llm_output'",
    "failure_fallback": f"WITH {ANSWERS} SELECT {_RESULT} FROM results WHERE label_status = 'llm_failed'",
    "classify_batches": f"WITH {ANSWERS} SELECT {_RESULT} FROM results",
    "classify_doubled": f"WITH {ANSWERS} SELECT {_RESULT} FROM results",
    "merge_labels": f"""WITH {MERGED} SELECT row_key, target_code, round(score, 6) AS score, label_category,
        label_relation, label_keep, label_priority, label_reason, label_status, label_error FROM merged""",
    "derive_label": f"""WITH x AS (SELECT doc_id, {_REL} AS r, {_CAT} AS c {_DOC_LABELS})
        SELECT doc_id, {label('r', 'c')} AS label FROM x""",
    "derive_flags": f"""WITH x AS (SELECT doc_id, {_REL} AS r, {_CAT} AS c {_DOC_LABELS})
        SELECT doc_id, c = 'diagnosis' AND r = 'exact_same' AS is_exact_diagnosis,
        c = 'lab' AND r IN ('directly_related', 'clinically_relevant') AS is_related_lab,
        c = 'medication' AND r IN ('directly_related', 'clinically_relevant') AS is_related_medication FROM x""",
    "label_ranks": f"""WITH x AS (SELECT doc_id, {_REL} AS r, {_CAT} AS c {_DOC_LABELS})
        SELECT doc_id, CAST({relation_rank('r')} AS BIGINT) AS relation_rank,
        CAST({category_rank('c')} AS BIGINT) AS category_rank FROM x""",
    "final_rank": f"WITH {MERGED} SELECT target_code, row_key, label, CAST(final_rank AS DOUBLE) AS final_rank FROM ranked",
    "label_run": f"""WITH {MERGED} SELECT row_key, target_code, target_name, target_category, accession, name,
        md5(description) AS description, study, dataset_name, round(score, 6) AS score, target_rank, passed,
        pass_label, context_group, label_category, label_relation, label_keep,
        CAST(label_priority AS BIGINT) AS label_priority, label_reason, label_status, label_error, label,
        is_exact_diagnosis, is_related_lab, is_related_medication, CAST(relation_rank AS BIGINT) AS relation_rank,
        CAST(category_rank AS BIGINT) AS category_rank, CAST(final_rank AS DOUBLE) AS final_rank FROM ranked""",
    "label_pipeline": f"""WITH {AGAIN} SELECT row_key, target_code, label, label_status, label_reason, label_error,
        CAST(final_rank AS DOUBLE) AS final_rank, a.run_seq, CAST(coalesce(a.run_seq + 1, 0) AS BIGINT) AS n_logged
        FROM ranked LEFT JOIN (SELECT row_key, run_seq FROM again) a USING (row_key)""",
    "label_counts": f"WITH {MERGED} " + _counts(
        ("label_category", "label_relation", "label", "label_keep", "label_status"), "merged"),
    "label_totals": f"""WITH {MERGED} SELECT count(*) FILTER (is_exact_diagnosis) AS is_exact_diagnosis,
        count(*) FILTER (is_related_lab) AS is_related_lab,
        count(*) FILTER (is_related_medication) AS is_related_medication,
        count(*) FILTER (label_status = 'llm_failed') AS n_failed,
        count(*) FILTER (target_code IS NULL) AS n_without_code FROM merged""",
    "target_label_rollup": f"""WITH {MERGED} SELECT target_code, count(*) AS n_candidates,
        count(*) FILTER (label_keep) AS n_keep, count(*) FILTER (is_exact_diagnosis) AS n_exact_diagnosis,
        count(*) FILTER (is_related_lab) AS n_related_lab,
        count(*) FILTER (is_related_medication) AS n_related_medication,
        count(*) FILTER (label_status = 'llm_failed') AS n_failed
        FROM merged WHERE target_code IS NOT NULL GROUP BY target_code""",
    "failed_targets": f"""WITH {MERGED} SELECT DISTINCT target_code, target_name FROM merged
        WHERE label_status = 'llm_failed'""",
    "latest_per_key": f"WITH {_LATEST} SELECT row_key, label_status, value, event_id FROM latest",
    "resume_pending": f"""WITH {_LATEST} SELECT CAST(c_custkey AS VARCHAR) AS row_key FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM latest WHERE latest.row_key = CAST(c_custkey AS VARCHAR)
                          AND label_status = 'ok')""",
    "log_union": f"""WITH {ANSWERS} SELECT row_key, label_relation, 'ok' AS label_status,
        CAST(CASE WHEN label_status = 'ok' THEN 0 ELSE 1 END AS BIGINT) AS run_seq FROM results""",
}
