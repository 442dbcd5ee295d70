"""The corpus pipeline: toxic documents go, one of each group of near copies stays, documents that hold test items go,
sources are mixed to their weights, and the rest is written as token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it as Parquet and reads it again as the
next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairwright.llm import decontaminate, mixing, simhash, tokens, toxicity
from pairwright.llm.common import cut, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on labelled documents of this input, applied to all of it."""
    ship_package(spark)
    model = toxicity.train(docs, toxicity.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprints of four-word shingles, linked at four differing bits or fewer; the smallest id of a group stays."""
    ship_package(spark)
    return simhash.keep_one(docs, width=4, distance=4)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them."""
    ship_package(spark)
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document written, read back from the files."""
    ship_package(spark)
    return tokens.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_test_items),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs


#: Ordinal regression, fingerprints, alignment and byte-pair encoding are beyond SQL; tests/llm checks the stages by hand.
ORACLE_SQL = None
