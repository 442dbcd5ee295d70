"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.functions.codes import keep_code, normalize_code, with_codes
from pairwright.functions.labels import final_label, is_exact_diagnosis, is_related, lookup
from pairwright.functions.numbers import to_number
from pairwright.functions.text import base_name, clean, key_form, short_hash, squeeze
from pairwright.functions.vectors import cosine, norm
from pairwright.operators.columns import clean_columns, fill_group
from pairwright.operators.embed import embed, fit_encoder
from pairwright.operators.merge import final_rank, merge_labels
from pairwright.operators.numbering import with_file_position
from pairwright.operators.pairs import first_targets, keep_passed, load_pairs, top_per_target, with_context_group
from pairwright.operators.prepare import first_rows, prepare_candidates, prepare_targets
from pairwright.operators.replies import classify, parse_replies, stray_items, validate_items
from pairwright.operators.report import failed_targets, label_counts, label_totals, target_rollup
from pairwright.operators.requests import BATCH, REQUEST_FIELDS, assign_batches, build_requests, target_headers
from pairwright.operators.select import adaptive_select, group_statistics, select_and_rank
from pairwright.operators.summary import (
    count_buckets, count_describe, count_quantiles, group_buckets, group_summary, inspect_by_group, inspect_top,
    target_summary, top_groups, top_targets, value_counts,
)
from pairwright.plans.labelling import label, open_requests
from pairwright.plans.lineage import cut
from pairwright.plans.retrieval import retrieve
from pairwright.settings import CATEGORY_RANKS, RELATION_RANKS, UNKNOWN_RANK, LabelSettings, RetrievalSettings
from pairwright.sources.names import CANDIDATE_COLUMNS, LABEL_COLUMNS, TARGET_COLUMNS
from pairwright.sources.tables import LOG_SCHEMA, append_log, read_log
from pairwright.streaming.runlog import latest_per_key, latest_results, pending
from registry import fragments as frag

MAD = RetrievalSettings(min_candidates=10, max_candidates=30)
SD = RetrievalSettings(min_candidates=10, max_candidates=30, spread="sd")
LABEL = LabelSettings()
NULLABLE_COUNTS = ("min_in_one_group", "max_in_one_group", "min_candidates", "max_candidates", "n_min_padded",
                   "n_max_capped")
WANTED = ("7", "010", "12.0", "250.1")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sql(spark: SparkSession, sf: str, text: str, *names: str) -> DataFrame:
    """Run a fragment over tables passed by name, without registering views."""
    tables = {name: table(spark, sf, name) for name in names}
    for name in names:
        text = text.replace(f"FROM {name}\n", f"FROM {{{name}}}\n")
    return spark.sql(text.replace('"database"', "`database`"), **tables)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# --- inputs ---------------------------------------------------------------------------------------------------------

def raw_targets(spark, sf):
    return sql(spark, sf, frag.RAW_TARGETS, "part")


def raw_candidates(spark, sf):
    return sql(spark, sf, frag.RAW_CANDIDATES, "documents")


def raw_pairs(spark, sf):
    return sql(spark, sf, frag.RAW_PAIRS, "documents")


def vectors(spark, sf):
    """All vectors as targets, and all as candidates grouped by their label."""
    e = table(spark, sf, "embeddings")
    return (e.select(F.col("vec_id").alias("target_id"), "embedding"),
            e.select(F.col("vec_id").alias("cand_id"), F.col("label").cast("string").alias("group"), "embedding"))


def selected(spark, sf, codes=None, text=F.col):
    """Retrieval over all vectors, with the columns of part and documents that go with an id.

    `text` makes the description from the text of a document, once for each document and not for each pair.

    Given `codes`, only their targets are scored: what a target gets does not depend on the others.
    """
    targets, candidates = vectors(spark, sf)
    if codes is not None:
        targets = with_codes(targets, "target_id", codes)
    part, docs = table(spark, sf, "part"), table(spark, sf, "documents")
    details = part.select(F.col("p_partkey").alias("target_id"), F.col("p_name").alias("target_name"),
                          F.col("p_type").alias("target_category"))
    texts = docs.select(F.col("doc_id").alias("cand_id"), text("text").alias("description"),
                        F.col("source").alias("study"), F.col("lang").alias("database"))
    rows = retrieve(targets, candidates, MAD, details, texts)
    return rows.withColumn("target_code", F.col("target_id").cast("string"))


# --- stage one ------------------------------------------------------------------------------------------------------

def q_targets(spark, sf):
    return prepare_targets(raw_targets(spark, sf), MAD).select("target_id", *TARGET_COLUMNS, "target_text")


def q_candidates(spark, sf):
    rows = prepare_candidates(raw_candidates(spark, sf), MAD)
    return rows.select("cand_id", "group", *CANDIDATE_COLUMNS, F.md5("cand_text").alias("text_md5"))


def q_clean_columns(spark, sf):
    return clean_columns(raw_targets(spark, sf), ("target_code", "target_name", "target_category", "visit"))


def q_normalize_code(spark, sf):
    return raw_targets(spark, sf).select("target_id", normalize_code(F.col("target_code")).alias("code"))


def q_code_filter(spark, sf):
    return raw_targets(spark, sf).where(keep_code(F.col("target_code"))).select("target_id")


def q_allow_list(spark, sf):
    rows = with_codes(raw_targets(spark, sf), "target_code", WANTED)
    return rows.select("target_id", normalize_code(F.col("target_code")).alias("code"))


def q_first_rows(spark, sf):
    return first_rows(q_targets(spark, sf), 25).select("target_id", "target_code")


def q_group_fill(spark, sf):
    rows = fill_group(clean_columns(raw_candidates(spark, sf), ("database",)), "database", "Database")
    return rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))


def q_render_text(spark, sf):
    t = prepare_targets(raw_targets(spark, sf), MAD).select(
        F.concat(F.lit("t"), "target_id").alias("id"), F.col("target_text").alias("text"))
    c = prepare_candidates(raw_candidates(spark, sf), MAD).select(
        F.concat(F.lit("c"), "cand_id").alias("id"), F.col("cand_text").alias("text"))
    return t.unionByName(c)


def q_embed_norm(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = embed(docs, "text", fit_encoder(docs))
    return rows.select("doc_id", F.size("embedding").cast("bigint").alias("width"),
                       F.round(norm(F.col("embedding")), 4).alias("norm"))


def q_pair_cosine(spark, sf):
    e = table(spark, sf, "embeddings")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(after, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


def q_similarity_all_pairs(spark, sf):
    stats = group_statistics(*vectors(spark, sf), MAD)
    return stats.groupBy("target_id").agg(
        F.sum("n_pool").alias("n_scores"), F.round(F.max("max_in_group"), 6).alias("best_score"))


def q_spread(settings, spark, sf):
    rows = group_statistics(*vectors(spark, sf), settings)
    return rounded(rows.select("target_id", "group", "n_pool", "max_in_group", "delta", "threshold", "n_above"),
                   "max_in_group", "delta", "threshold")


def q_adaptive_select(settings, spark, sf):
    rows = adaptive_select(*vectors(spark, sf), settings)
    return rounded(rows, "score", "max_in_group", "delta", "threshold")


def q_global_rank(spark, sf):
    rows = select_and_rank(*vectors(spark, sf), MAD)
    return rounded(rows.select("target_id", "cand_id", "group", "rank_in_group", "target_rank", "max_for_target"),
                   "max_for_target")


def q_retrieve(spark, sf):
    rows = selected(spark, sf, text=lambda name: F.length(name).cast("bigint"))
    return rounded(rows, "score", "max_in_group", "max_for_target", "delta", "threshold")


def part_targets(spark, sf):
    """All of part as the target table: most of its rows have no pairs."""
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("target_code"), F.col("p_name").alias("target_name"),
        F.col("p_type").alias("target_category"))


def by_target(spark, sf):
    return target_summary(part_targets(spark, sf), selected(spark, sf))


def by_group(spark, sf):
    return group_summary(selected(spark, sf))


def q_target_summary(spark, sf):
    rows = rounded(by_target(spark, sf), "max_for_target")
    return rows.withColumns({c: F.col(c).cast("double") for c in NULLABLE_COUNTS})


def q_group_summary(spark, sf):
    return rounded(by_group(spark, sf), "max_in_group", "threshold", "delta")


def q_count_describe(spark, sf):
    return rounded(count_describe(by_target(spark, sf)), "mean", "std", "p25", "p50", "p75")


def q_count_quantiles(spark, sf):
    return rounded(count_quantiles(by_group(spark, sf)), "value")


def q_count_buckets(spark, sf):
    return count_buckets(by_target(spark, sf))


def q_group_buckets(spark, sf):
    return group_buckets(by_group(spark, sf), MAD)


def q_top_targets(spark, sf):
    return top_targets(by_target(spark, sf)).select("target_code", "n_candidates")


def q_top_groups(spark, sf):
    return top_groups(by_group(spark, sf)).select("target_code", "group", "n_candidates")


def q_inspect_top(spark, sf):
    rows = inspect_top(selected(spark, sf, WANTED), WANTED, 20)
    return rows.select("target_code", "target_rank", "cand_id", "group", "rank_in_group", F.round("score", 6).alias("score"))


def q_inspect_by_group(spark, sf):
    rows = inspect_by_group(selected(spark, sf, WANTED), WANTED, 10)
    return rows.select("target_code", "group", "rank_in_group", "cand_id", F.round("score", 6).alias("score"))


def q_value_counts(spark, sf):
    return value_counts(prepare_candidates(raw_candidates(spark, sf), MAD), ("study", "group"))


# --- stage two ------------------------------------------------------------------------------------------------------

def loaded(spark, sf):
    """The keyed pairs, cut once: everything below reads them several times."""
    return cut(load_pairs(raw_pairs(spark, sf), LABEL))


def stand_in_replies(spark, sf, rows, sound=False):
    """A reply text per batch, from the given labels, in eight kinds; all sound ones on request."""
    facts = rows.select(*BATCH, "position", "row_key", F.substring("accession", 4, 20).cast("bigint").alias("doc_id"))
    facts = facts.join(table(spark, sf, "labels"), "doc_id", "left")
    item = F.to_json(F.struct(
        F.col("row_key").alias("row_id"), F.expr(frag.ANSWER_CATEGORY).alias("clinical_category"),
        F.expr(frag.ANSWER_RELATION).alias("relation_level"), F.concat(F.lit(" doc  "), "doc_id").alias("reason")))
    groups = facts.groupBy(*BATCH).agg(F.array_sort(F.collect_list(F.struct("position", item.alias("item")))).alias("l"))
    items = F.when(F.col("kind") == 7, F.slice("l.item", F.lit(2), F.size("l.item"))).otherwise(F.col("l.item"))
    body = F.concat(F.lit('{"results": ['), F.array_join(items, ", "), F.lit("]}"))
    reply = (F.when(F.col("kind") == 1, F.concat(F.lit("```JSON\n"), body, F.lit("\n```")))
             .when(F.col("kind") == 2, F.concat(F.lit("Here you are: "), body, F.lit(" Anything else?")))
             .when(F.col("kind") == 3, F.concat(F.lit('{"results": ['), F.array_join(items, ", ")))
             .when(F.col("kind") == 4, F.lit('{"results": []}'))
             .when(F.col("kind") == 5, F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")))
             .when(F.col("kind") == 6, F.lit('{"results": null}'))
             .otherwise(body))
    kind = F.lit(0) if sound else F.expr(frag.REPLY_KIND)
    return groups.withColumn("kind", kind).select(*BATCH, reply.alias("reply"))


def asked(spark, sf):
    """Keyed pairs, their requests, and a reply to each request."""
    rows = loaded(spark, sf)
    batches = assign_batches(rows, LABEL)
    return rows, build_requests(batches, target_headers(rows), LABEL), stand_in_replies(spark, sf, batches)


def results(spark, sf):
    _, requests, replies = asked(spark, sf)
    return classify(requests, replies, LABEL)


def merged(spark, sf):
    rows, requests, replies = asked(spark, sf)
    return merge_labels(rows, classify(requests, replies, LABEL), LABEL)


def q_load_candidates(spark, sf):
    return load_pairs(raw_pairs(spark, sf), LABEL).withColumn("description", F.md5("description"))


def q_coerce_numeric(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", to_number(F.col("c_acctbal").cast("string")).alias("balance"),
                    to_number(F.col("c_mktsegment")).alias("segment"), to_number(F.lit("NaN")).alias("not_a_number"))


def q_row_key(spark, sf):
    return load_pairs(raw_pairs(spark, sf), LABEL).select("accession", "row_key")


def q_context_group(spark, sf):
    return load_pairs(raw_pairs(spark, sf), LABEL).select("row_key", "context_group", short_hash(F.col("description")).alias("text_hash"))


def q_norm_key(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.md5(key_form(F.col("text"))).alias("key_md5"),
                    F.md5(squeeze(F.col("text"))).alias("squeezed_md5"), F.length(clean(F.col("text"))).cast("bigint")
                    .alias("n"))


def q_base_name(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat("p_name", F.expr(
        "CASE p_size % 6 WHEN 0 THEN '_visit_2' WHEN 1 THEN 'v3' WHEN 2 THEN ' Yr 1' WHEN 3 THEN '_day_3_visit_2' "
        "WHEN 4 THEN '_FU_12_' ELSE '' END"))
    return p.select("p_partkey", base_name(name).alias("base"))


def q_pass_filter(spark, sf):
    return keep_passed(raw_pairs(spark, sf)).select("accession")


def q_topn_per_target(spark, sf):
    rows = load_pairs(raw_pairs(spark, sf), LabelSettings(top_n=15))
    return rows.select("target_code", "accession", F.round("score", 6).alias("score"))


def q_first_n_targets(spark, sf):
    rows = loaded(spark, sf)
    return first_targets(rows, 5, F.col("target_rank")).groupBy("target_code").agg(F.count(F.lit(1)).alias("n"))


def q_assign_batches(spark, sf):
    return assign_batches(loaded(spark, sf), LABEL).select("target_code", "row_key", "position", "batch_no")


def q_first_targets_by_place(spark, sf):
    """The rows that stage two would ask for, of the first three targets by their place in the file."""
    settings = LabelSettings(first_targets=3)
    place = with_file_position(table(spark, sf, "documents").select("doc_id")).select(
        F.concat(F.lit("acc"), "doc_id").alias("accession"), "input_order")
    pairs = cut(load_pairs(raw_pairs(spark, sf).join(place, "accession"), settings))
    made = open_requests(pairs, spark.createDataFrame([], LOG_SCHEMA), settings)
    return made.groupBy("target_code").agg(F.sum("n_rows").alias("n"))


def q_request_head(spark, sf):
    """All of every request text but the list of variables, which `request_text` has."""
    requests = asked(spark, sf)[1]
    head = F.expr("substring(request, 1, length(request) - length(payload))")
    return requests.select("target_code", "batch_no", F.md5(head).alias("head_md5"))


def q_build_requests(spark, sf):
    rows = asked(spark, sf)[1]
    return rows.select(*BATCH, "n_rows", F.array_join("row_keys", ",").alias("row_keys"), "target_name",
                       "target_category")


def q_request_text(spark, sf):
    """Every candidate of every request, read back from the text that would be sent."""
    item = "array<struct<" + ", ".join(
        f"{name}: {'double' if column == 'score' else 'bigint' if column == 'target_rank' else 'string'}"
        for name, column in REQUEST_FIELDS) + ">>"
    sent = F.substring_index("request", "Variables:\n", -1)
    rows = asked(spark, sf)[1].select("target_code", F.explode(F.from_json(sent, item)).alias("r")).select(
        "target_code", "r.*")
    return rows.withColumns({"variable_description": F.md5("variable_description"),
                             "cosine_similarity": F.round("cosine_similarity", 6),
                             "step1_rank": F.col("step1_rank").cast("double")})


def q_parse_replies(spark, sf):
    parsed = parse_replies(asked(spark, sf)[2])
    return parsed.select(*BATCH, F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"))


def q_reply_status(spark, sf):
    parsed = parse_replies(asked(spark, sf)[2])
    return parsed.groupBy("reply_error").agg(F.count(F.lit(1)).alias("n"))


def q_validate_items(spark, sf):
    parsed = parse_replies(asked(spark, sf)[2])
    return validate_items(parsed).drop("item_no")


def q_stray_items(spark, sf):
    """Replies handed to the neighbour batch: everything in them is stray."""
    _, requests, replies = asked(spark, sf)
    moved = replies.withColumn("batch_no", F.col("batch_no") + 1)
    return stray_items(requests, parse_replies(moved)).select(*BATCH, "row_key")


def q_status(status, spark, sf):
    return results(spark, sf).where(F.col("label_status") == status)


def q_classify_batches(spark, sf):
    return results(spark, sf)


def q_classify_doubled(spark, sf):
    """Every reply twice and a broken one besides: the results are those of single replies."""
    _, requests, replies = asked(spark, sf)
    broken = replies.withColumn("reply", F.lit("~ broken"))
    return classify(requests, replies.unionByName(broken).unionByName(replies), LABEL)


def q_merge_labels(spark, sf):
    rows = merged(spark, sf)
    return rows.select("row_key", "target_code", F.round("score", 6).alias("score"), *LABEL_COLUMNS)


def q_derive_label(spark, sf):
    c, r = F.expr(f"trim(lower({frag.ANSWER_CATEGORY}))"), F.expr(f"trim(lower({frag.ANSWER_RELATION}))")
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", final_label(r, c).alias("label"))


def q_derive_flags(spark, sf):
    c, r = F.expr(f"trim(lower({frag.ANSWER_CATEGORY}))"), F.expr(f"trim(lower({frag.ANSWER_RELATION}))")
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", is_exact_diagnosis(r, c).alias("is_exact_diagnosis"),
                       is_related("lab", r, c).alias("is_related_lab"),
                       is_related("medication", r, c).alias("is_related_medication"))


def q_label_ranks(spark, sf):
    c, r = F.expr(f"trim(lower({frag.ANSWER_CATEGORY}))"), F.expr(f"trim(lower({frag.ANSWER_RELATION}))")
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", lookup(r, RELATION_RANKS, UNKNOWN_RANK).cast("bigint").alias("relation_rank"),
                       lookup(c, CATEGORY_RANKS, UNKNOWN_RANK).cast("bigint").alias("category_rank"))


def q_final_rank(spark, sf):
    rows = final_rank(cut(merged(spark, sf)), LABEL)
    return rows.select("target_code", "row_key", "label", F.col("final_rank").cast("double").alias("final_rank"))


def q_label_run(spark, sf):
    rows = final_rank(cut(merged(spark, sf)), LABEL).drop("form_name", "table_name", "visit", "visit_name", "collection_event",
                                              "dataset_accession", "database", "type")
    rows = rows.withColumn("description", F.md5("description"))
    ints = {c: F.col(c).cast("bigint") for c in ("label_priority", "relation_rank", "category_rank")}
    ints["final_rank"] = F.col("final_rank").cast("double")
    return rounded(rows.withColumns(ints), "score")


def q_label_pipeline(spark, sf):
    """Two runs over one log. Some replies of the first fail or leave rows out; the second asks for just these rows again."""
    pairs = loaded(spark, sf)
    path = f"{spark.sparkContext.getCheckpointDir()}/label-log-{uuid.uuid4().hex}"
    for run_seq, sound in enumerate((False, True)):
        log = read_log(spark, path)
        requests = cut(open_requests(pairs, log, LABEL))
        place = F.posexplode("row_keys").alias("position", "row_key")
        asked_for = requests.select(*BATCH, place).join(pairs.select("row_key", "accession"), "row_key")
        replies = stand_in_replies(spark, sf, asked_for, sound)
        append_log(classify(requests, replies, LABEL), path, run_seq)
    log = read_log(spark, path)
    rows = label(pairs, log, LABEL).join(latest_results(log).select("row_key", "run_seq"), "row_key", "left")
    counted = log.groupBy("row_key").agg(F.count(F.lit(1)).alias("n_logged"))
    return rows.join(counted, "row_key", "left").select(
        "row_key", "target_code", "label", "label_status", "label_reason", "label_error", F.col("final_rank").cast("double").alias("final_rank"),
        "run_seq", F.coalesce("n_logged", F.lit(0)).cast("bigint").alias("n_logged"))


def q_label_counts(spark, sf):
    return label_counts(merged(spark, sf))


def q_label_totals(spark, sf):
    return label_totals(merged(spark, sf))


def q_target_label_rollup(spark, sf):
    return target_rollup(merged(spark, sf))


def q_failed_targets(spark, sf):
    return failed_targets(merged(spark, sf))


def events_log(spark, sf):
    status = F.when(F.col("event_type") == "error", "llm_failed").otherwise("ok")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("row_key"), status.alias("label_status"), "value", "event_id",
        F.struct("ts", "event_id").alias("run_seq"))


def q_latest_per_key(spark, sf):
    rows = latest_per_key(events_log(spark, sf), ["row_key"], ["run_seq"])
    return rows.select("row_key", "label_status", "value", "event_id")


def q_resume_pending(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("row_key"))
    return pending(customers, events_log(spark, sf), LABEL)


def q_log_union(spark, sf):
    """Two runs in one log, the second one over the rows that failed in the first."""
    first = cut(results(spark, sf).drop(*BATCH))
    failed = first.where(F.col("label_status") != "ok")
    again = failed.withColumns({"label_status": F.lit("ok"), "label_reason": F.lit("second try"),
                                "label_error": F.lit("")})
    log = first.withColumn("run_seq", F.lit(0)).unionByName(again.withColumn("run_seq", F.lit(1)))
    rows = latest_per_key(log, ["row_key"], ["run_seq"])
    return rows.select("row_key", "label_relation", "label_status", F.col("run_seq").cast("bigint").alias("run_seq"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "targets": q_targets,
    "candidates": q_candidates,
    "clean_columns": q_clean_columns,
    "normalize_code": q_normalize_code,
    "code_filter": q_code_filter,
    "allow_list": q_allow_list,
    "first_rows": q_first_rows,
    "group_fill": q_group_fill,
    "render_text": q_render_text,
    "embed_norm": q_embed_norm,
    "pair_cosine": q_pair_cosine,
    "similarity_all_pairs": q_similarity_all_pairs,
    "spread_mad": partial(q_spread, MAD),
    "spread_sd": partial(q_spread, SD),
    "adaptive_select": partial(q_adaptive_select, MAD),
    "adaptive_select_sd": partial(q_adaptive_select, SD),
    "global_rank": q_global_rank,
    "retrieve": q_retrieve,
    "target_summary": q_target_summary,
    "group_summary": q_group_summary,
    "count_describe": q_count_describe,
    "count_quantiles": q_count_quantiles,
    "count_buckets": q_count_buckets,
    "group_buckets": q_group_buckets,
    "top_targets": q_top_targets,
    "top_groups": q_top_groups,
    "inspect_top": q_inspect_top,
    "inspect_by_group": q_inspect_by_group,
    "value_counts": q_value_counts,
    "load_candidates": q_load_candidates,
    "coerce_numeric": q_coerce_numeric,
    "row_key": q_row_key,
    "context_group": q_context_group,
    "norm_key": q_norm_key,
    "base_name": q_base_name,
    "pass_filter": q_pass_filter,
    "topn_per_target": q_topn_per_target,
    "first_n_targets": q_first_n_targets,
    "assign_batches": q_assign_batches,
    "first_targets_by_place": q_first_targets_by_place,
    "build_requests": q_build_requests,
    "request_head": q_request_head,
    "request_text": q_request_text,
    "parse_replies": q_parse_replies,
    "reply_status": q_reply_status,
    "validate_items": q_validate_items,
    "stray_items": q_stray_items,
    "missing_fallback": partial(q_status, "missing_from_llm_output"),
    "failure_fallback": partial(q_status, "llm_failed"),
    "classify_batches": q_classify_batches,
    "classify_doubled": q_classify_doubled,
    "merge_labels": q_merge_labels,
    "derive_label": q_derive_label,
    "derive_flags": q_derive_flags,
    "label_ranks": q_label_ranks,
    "final_rank": q_final_rank,
    "label_run": q_label_run,
    "label_pipeline": q_label_pipeline,
    "label_counts": q_label_counts,
    "label_totals": q_label_totals,
    "target_label_rollup": q_target_label_rollup,
    "failed_targets": q_failed_targets,
    "latest_per_key": q_latest_per_key,
    "resume_pending": q_resume_pending,
    "log_union": q_log_union,
}
