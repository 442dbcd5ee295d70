"""Text to unit vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.plans.lineage import cut

Encode = Callable[[Sequence[str]], np.ndarray]


def fit_encoder(texts: DataFrame, column: str = "text", width: int = 256) -> PipelineModel:
    """Hashed words weighted by inverse document frequency; fit it once on the texts of both sides."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=column, outputCol="_words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit"),
    ]).fit(texts)


def embed(df: DataFrame, column: str, model: PipelineModel) -> DataFrame:
    """Adds `embedding` from a fitted encoder. A text without words gets the zero vector."""
    text = model.stages[0].getInputCol()
    rows = df if text == column else df.withColumnRenamed(column, text)
    rows = model.transform(rows).withColumn("embedding", vector_to_array("_unit", "float32"))
    rows = rows.drop("_words", "_counts", "_weights", "_unit")
    return rows if text == column else rows.withColumnRenamed(text, column)


def embed_with(df: DataFrame, column: str, load: Callable[[], Encode], batch: int = 32) -> DataFrame:
    """Adds `embedding` from any encoder. `load` runs once per task; `encode` gets `batch` texts at a time.

    Texts are addressed by 128 bits of hashes, and each different one is encoded once, null as the empty text: only
    (address, text) goes to Python, and the vectors, which are written, are joined to the rows by address.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    address = {"_text_a": F.xxhash64(F.lit(1), text), "_text_b": F.xxhash64(F.lit(2), text)}
    texts = df.select(text.alias("text"), *[c.alias(name) for name, c in address.items()])
    texts = texts.groupBy(*address).agg(F.min("text").alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for frame in frames:
            given = frame["text"].tolist()
            rows: list[np.ndarray] = []
            for start in range(0, len(given), batch):
                vectors = np.asarray(encode(given[start:start + batch]), dtype=np.float64)
                sizes = np.linalg.norm(vectors, axis=1, keepdims=True)
                rows.extend((vectors / np.where(sizes == 0, 1, sizes)).astype(np.float32))
            yield frame.drop(columns="text").assign(embedding=rows)

    encoded = cut(texts.mapInPandas(run, "_text_a bigint, _text_b bigint, embedding array<float>"))
    return df.withColumns(address).join(encoded, list(address)).select(*df.columns, "embedding")
