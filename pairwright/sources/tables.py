"""Readers and writers. CSV columns are read as text; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.functions.codes import with_codes
from pairwright.functions.text import blank_missing
from pairwright.operators.numbering import with_file_position
from pairwright.settings import MISSING_TOKENS
from pairwright.sources.names import ALL_HEADERS, CANDIDATE_HEADERS, LABEL_HEADERS, TARGET_HEADERS, header_of
from pairwright.sources.split_csv import records

LOG_SCHEMA = ("row_key string, label_category string, label_relation string, label_keep boolean, "
              "label_priority int, label_reason string, label_status string, label_error string, run_seq bigint")


_CSV = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, headers: dict[str, str], tokens: Iterable[str] = MISSING_TOKENS,
             multi_line: bool = True, split: bool = True) -> DataFrame:
    """CSV files with a header: all columns as text, known headers renamed, missing tokens blanked, and `input_order`.

    Cells may hold line breaks. Files are read by byte ranges in parallel all the same, and `input_order` counts the
    records of all files, the same for any ranges. `split=False` reads each file in one task, for files whose quotes do not
    follow RFC 4180. With `multi_line=False` no cell may hold a line break, and there is no `input_order`.
    """
    reader = spark.read.option("header", True).options(**_CSV).option("multiLine", multi_line).option("inferSchema", False)
    raw = reader.csv(path)
    names = raw.columns
    if multi_line and split:
        schema = ", ".join(f"c{k} string" for k in range(len(names)))
        cells = F.from_csv("record", schema, {**_CSV, "multiLine": "true"}).alias("cells")
        rows = records(spark, path).select(F.col("position").alias("input_order"), cells)
        raw = rows.select(*[F.col(f"cells.c{k}").alias(c) for k, c in enumerate(names)], "input_order")
    elif multi_line:
        raw = raw.withColumn("input_order", F.monotonically_increasing_id())
    columns = [blank_missing(F.coalesce(F.col(f"`{c}`"), F.lit("")), tuple(tokens)).alias(headers.get(c, c)) for c in names]
    return raw.select(*columns, *(["input_order"] if multi_line else []))


def _read_inputs(spark: SparkSession, path: str, fmt: str, headers: dict[str, str], multi_line: bool, split: bool) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, headers, multi_line=multi_line, split=split)
    raw = spark.read.parquet(path)
    return raw.select(*[F.col(f"`{c}`").alias(headers.get(c, c)) for c in raw.columns])


def read_targets(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True, split: bool = True) -> DataFrame:
    """The target file, as CSV or as Parquet with either set of names."""
    return _read_inputs(spark, path, fmt, TARGET_HEADERS, multi_line, split)


def read_candidates(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True, split: bool = True) -> DataFrame:
    return _read_inputs(spark, path, fmt, CANDIDATE_HEADERS, multi_line, split)


def read_selected(spark: SparkSession, path: str, fmt: str = "parquet", ordered: bool = False, split: bool = True) -> DataFrame:
    """Stage-one rows: Parquet between the stages, or a CSV file of them. `ordered` adds `input_order` to Parquet rows too."""
    if fmt != "parquet":
        return read_csv(spark, path, ALL_HEADERS, split=split)
    raw = spark.read.parquet(path)
    return with_file_position(raw) if ordered else raw


def write_table(df: DataFrame, path: str, fmt: str = "parquet", file_headers: bool = False, order: Iterable[str] = ()) -> None:
    """Replace a table; `file_headers` writes the headers of the files instead of the column names. With `order`, the
    rows of all files in turn are in that order."""
    if order := [F.col(c).asc_nulls_last() for c in order if c in df.columns]:
        df = df.orderBy(*order)
    if file_headers:
        names = {v: k for k, v in ALL_HEADERS.items()}
        df = df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.parquet(path)


def append_log(results: DataFrame, path: str, run_seq: int) -> None:
    """Add one run's results to the log. A job that fails leaves no committed rows behind."""
    columns = [*LABEL_HEADERS.values(), F.lit(run_seq).cast("bigint").alias("run_seq")]
    results.select(*columns).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All log rows; an absent log is an empty one."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def read_replies(spark: SparkSession, path: str) -> DataFrame:
    """All replies of all runs and slices; an absent table is an empty one."""
    schema = "target_code string, batch_no bigint, reply string, error string, run_seq bigint, slice int"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def next_run_seq(log: DataFrame) -> int:
    last = log.agg(F.max("run_seq")).first()[0]
    return 0 if last is None else last + 1


def write_inspection(ranked: DataFrame, path: str, codes: Iterable[str]) -> None:
    """One folder per wanted target with CSV files under the headers of the files, the code among them; targets without
    rows get none. Rows are dealt out by ranges of (code, rank), so a code with many rows is written by several tasks, and
    its files in turn are in order of rank."""
    rows = with_codes(ranked, "target_code", codes)
    order = [F.col(c).asc_nulls_last() for c in ("target_code", "final_rank") if c in rows.columns]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    named = rows.select(*[F.col(c).alias(header_of(c)) for c in rows.columns], F.col("target_code").alias("target_code"))
    named.write.mode("overwrite").partitionBy("target_code").option("header", True).option("escape", '"').csv(path)
