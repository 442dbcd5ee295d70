"""Stage two: from stage-one pairs to ranked labels."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.operators.merge import final_rank, merge_labels
from pairwright.operators.pairs import first_targets, load_pairs
from pairwright.operators.replies import ask, classify
from pairwright.operators.requests import BATCH, assign_batches, build_requests, target_headers
from pairwright.plans.lineage import cut
from pairwright.settings import LabelSettings
from pairwright.sources.tables import append_log, next_run_seq, read_log, read_replies, write_inspection, write_table
from pairwright.streaming.runlog import latest_results, pending


_ORDER = ("target_code", "final_rank", "row_key")


def open_requests(pairs: DataFrame, log: DataFrame, settings: LabelSettings) -> DataFrame:
    """Requests for the pairs that still need a label, in slices of about `batches_per_commit`; of the first targets by
    their place in the file, where it is known."""
    order = F.col("target_order") if "target_order" in pairs.columns else None
    rows = pairs if settings.first_targets is None else first_targets(pairs, settings.first_targets, order)
    rows = cut(pending(rows, log, settings))
    headers = cut(target_headers(rows))
    batches = headers.agg(F.coalesce(F.sum(F.ceil(F.col("n_pending") / settings.batch_size)), F.lit(0))).first()[0]
    slices = max(1, -(-int(batches) // settings.batches_per_commit))
    requests = build_requests(assign_batches(rows, settings), headers, settings)
    return requests.withColumn("slice", F.pmod(F.xxhash64(*BATCH), F.lit(slices)).cast("int"))


def label(pairs: DataFrame, log: DataFrame, settings: LabelSettings) -> DataFrame:
    """Pairs with the latest labels of the log, derived columns and final ranks."""
    return final_rank(cut(merge_labels(pairs, latest_results(log), settings)), settings)


def write_requests(selected: DataFrame, settings: LabelSettings, out: str) -> DataFrame:
    """The requests a run over `out` would make now, for a service that answers elsewhere. Keys come from content,
    so the later `run_labelling` over the same rows and log asks for the same batches."""
    log = read_log(selected.sparkSession, f"{out}/log")
    write_table(load_pairs(selected, settings), f"{out}/pairs")
    pairs = selected.sparkSession.read.parquet(f"{out}/pairs")
    path = f"{out}/requests/run_seq={next_run_seq(log)}"
    requests = open_requests(pairs, log, settings)
    requests.repartition("slice").write.mode("overwrite").partitionBy("slice").parquet(path)
    return selected.sparkSession.read.schema(requests.schema).parquet(path)


def log_left_over(spark: SparkSession, settings: LabelSettings, out: str) -> None:
    """Answers that a run wrote but did not live to log are logged now, under that run's number, and never asked for again."""
    replies = read_replies(spark, f"{out}/replies")
    last = replies.agg(F.max("run_seq")).first()[0]
    if last is None:
        return
    replies = replies.where(F.col("run_seq") == last)
    asked = spark.read.parquet(f"{out}/requests/run_seq={last}").join(replies.select(*BATCH).distinct(), list(BATCH), "left_semi")
    logged = read_log(spark, f"{out}/log").where(F.col("run_seq") == last).select("row_key")
    lost = cut(classify(asked, replies, settings).join(logged, "row_key", "left_anti"))
    if not lost.isEmpty():
        append_log(lost, f"{out}/log", last)


@dataclass(frozen=True)
class Labelling:
    merged: DataFrame
    ranked: DataFrame


def run_labelling(selected: DataFrame, settings: LabelSettings, out: str,
                  replies: Callable[[DataFrame], DataFrame] | None = None,
                  load_classifier: Callable | None = None, inspect_codes: tuple[str, ...] = (),
                  fmt: str = "parquet", file_headers: bool = False) -> Labelling:
    """Load, ask for what is pending, log, merge, rank and write under `out`.

    Answers come from `load_classifier` or from `replies`, which turns the requests into a reply table. They are
    asked for, written and logged in slices of about `batches_per_commit` batches, each read from its own files, so a run that dies loses one slice at
    most, and what it wrote without logging is logged by the next run.
    """
    spark = selected.sparkSession
    log_path = f"{out}/log"
    if replies is None and load_classifier is None:
        raise ValueError("give either a reply table or a classifier")
    log_left_over(spark, settings, out)
    run_seq = next_run_seq(read_log(spark, log_path))
    requests = write_requests(selected, settings, out)
    pairs = spark.read.parquet(f"{out}/pairs").drop("target_order")
    for k in sorted(r["slice"] for r in requests.select("slice").distinct().collect()):
        part = requests.where(F.col("slice") == k).drop("slice")  # a folder of its own: no other slice is read
        path = f"{out}/replies/run_seq={run_seq}/slice={k}"
        write_table(replies(part) if replies is not None else ask(part, load_classifier), path)
        append_log(classify(part, spark.read.parquet(path), settings), log_path, run_seq)
    merged = merge_labels(pairs, latest_results(read_log(spark, log_path)), settings)
    write_table(merged, f"{out}/merged")
    merged = spark.read.parquet(f"{out}/merged")
    write_table(final_rank(merged, settings), f"{out}/ranked", order=_ORDER)
    ranked = spark.read.parquet(f"{out}/ranked")
    if fmt != "parquet":
        write_table(merged, f"{out}/merged_{fmt}", fmt, file_headers)
        write_table(ranked, f"{out}/ranked_{fmt}", fmt, file_headers, _ORDER)
    if inspect_codes:
        write_inspection(ranked, f"{out}/inspect", inspect_codes)
    return Labelling(merged, ranked)
