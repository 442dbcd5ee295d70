"""Registered queries of the folder against SQL where SQL has them, and all of them for their columns and rows."""

import glob
import os
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from pairwright.llm import decontaminate, mixing, simhash, toxicity
from pairwright.llm.common import cut
from pairwright.llm.oracle import ORACLE
from pairwright.llm.spark_queries import QUERIES
from tests.llm.test_secrets import plain as plain_secrets
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_all_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(k) for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, duck, name):
    found = duck.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    assert sorted(tuple(r[c] for c in columns) for r in QUERIES[name](spark, sf_dir).collect()) == sorted(found.fetchall())


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_simhash_and_secrets_over_the_table(spark, sf_dir, texts):
    fps = {i: plain_fingerprint(t, 4) for i, t in texts.items()}
    ids = sorted(fps)
    roots = plain_components([fps[i] for i in ids], lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{fps[i]:016x}", ids[r]) for i, r in zip(ids, roots, strict=True)}
    found = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in QUERIES["op10_secrets"](spark, sf_dir).collect()}
    assert found == {i: plain_secrets(t) for i, t in texts.items()}


def test_tokens_over_the_table(spark, sf_dir, texts):
    library, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, {}
    for i in sorted(texts):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op5_tokens"](spark, sf_dir).collect()} == want


def test_pipeline_stages(spark, sf_dir, texts):
    """Each stage against what its operator says of the stage's own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, out = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "mixing", "token_output"]
    for name, stage in corpus_pipeline.STAGES:
        made = cut(stage(spark, docs, sf_dir))
        out[name] = (docs, made)
        if name != "token_output":
            assert made.columns == columns and all(texts[r.doc_id] == r.text for r in made.select("doc_id", "text").collect())
        docs = made
    ids = lambda df: [r.doc_id for r in df.select("doc_id").collect()]
    before, after = out["toxicity"]
    model = toxicity.train(before, toxicity.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    assert sorted(ids(after)) == sorted(ids(toxicity.score(before, model).where("not toxic")))
    before, after = out["simhash_near_dedup"]
    assert sorted(ids(after)) == sorted(set(r.component_id for r in simhash.near_fingerprints(before, width=4, distance=4).collect()))
    before, after = out["benchmark_decontamination"]
    items = {r.item_id: decontaminate.normal(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    bad = {r.doc_id for r in decontaminate.contaminated(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert set(ids(after)) == set(ids(before)) - bad
    assert not [i for i in ids(after) if any(item in decontaminate.normal(texts[i]) for item in items.values())]
    before, after = out["mixing"]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    assert {i: ids(after).count(i) for i in set(ids(after))} == {i: n for i, n in copies.items() if n}
    before, after = out["token_output"]
    assert sorted(ids(after)) == sorted(ids(before))
