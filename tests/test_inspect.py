"""Inspection of a few targets scores those alone, with the rows that a run over all targets has."""

import numpy as np
from pyspark.sql import functions as F

from registry import spark_queries as sq


def test_only_wanted_targets_are_scored(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    ids = [*range(40), 250, None, 7]
    vectors = rng.normal(size=(len(ids), 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.tolist()
    spark.createDataFrame([(k, v, k % 3 if k else None) for k, v in zip(ids, vectors, strict=True)],
                          "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(k, f"part {k}", "kind") for k in range(20)], "p_partkey long, p_name string, p_type string").write.parquet(
        f"{tmp_path}/part.parquet")
    spark.createDataFrame([(k, "some text", "src", "en") for k in range(30)],
                          "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    every = sq.selected(spark, str(tmp_path)).where(F.col("target_id").isin(7, 10, 12)).select("target_id", "group", "cand_id", "score")
    every = sorted((tuple(r) for r in every.collect()), key=repr)
    asked, plain = [], sq.retrieve

    def retrieve(targets, *others):
        asked.append(sorted(r.target_id for r in targets.select("target_id").collect()))
        return plain(targets, *others)

    monkeypatch.setattr(sq, "retrieve", retrieve)
    assert sq.q_inspect_top(spark, str(tmp_path)).count() and sq.q_inspect_by_group(spark, str(tmp_path)).count()
    assert asked == [[7, 7, 10, 12]] * 2
    few = sq.selected(spark, str(tmp_path), sq.WANTED).select("target_id", "group", "cand_id", "score").collect()
    assert sorted((tuple(r) for r in few), key=repr) == every
