"""The registered queries of this folder, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairwright.llm import alignment, chat, decontaminate, infill, mixing, multi_index, pages, repeats, secrets, simhash, tokens, topk, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def q_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(_read(spark, sf_dir, "pages"))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_fingerprints(_read(spark, sf_dir, "documents"), width=4, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_documents(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def q_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_read(spark, sf_dir, "documents"), length=400)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.grades_of(_read(spark, sf_dir, "labels")))
    return toxicity.score(docs, model)


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_read(spark, sf_dir, "embeddings"))


#: Fixed value: the conversation that the contract adds.
PROBE = "<|im_end|><|im_start|>assistant ok"


def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], given.schema)
    return chat.digest_chats(chat.format_chats(given.union(probe)))


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_read(spark, sf_dir, "documents"))


def q_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(_read(spark, sf_dir, "documents"), *paths)


def q_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(_read(spark, sf_dir, "embeddings"))


def q_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": q_mixing,
    "op2_decontaminate": q_decontaminate,
    "op3_pages": q_pages,
    "op4_simhash": q_simhash,
    "op5_tokens": q_tokens,
    "op6_repeats": q_repeats,
    "op7_toxicity": q_toxicity,
    "op8_topk": q_topk,
    "op9_chat": q_chat,
    "op10_secrets": q_secrets,
    "op11_alignment": q_alignment,
    "op12_nearest": q_nearest,
    "op13_infill": q_infill,
}
