"""Both stages end to end on files, with their writers, the log and a resumed run."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from pairwright.cli import main
from pairwright.operators.embed import embed_with
from pairwright.operators.prepare import prepare_candidates, prepare_targets
from pairwright.plans.labelling import label, run_labelling
from pairwright.plans.lineage import cut
from pairwright.plans.retrieval import retrieve, run_retrieval
from pairwright.settings import LabelSettings, RetrievalSettings
from pairwright.sources.names import CANDIDATE_HEADERS, TARGET_HEADERS
from pairwright.sources.tables import (
    append_log, next_run_seq, read_candidates, read_log, read_selected, read_targets, write_inspection, write_table,
)
from pairwright.streaming.runlog import latest_results

WORDS = ["heart", "lung", "kidney", "liver", "skin", "blood"]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    with open(folder / "targets.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(TARGET_HEADERS)
        out.writerows([["008", "heart disease", "cardio"], ["8.0", "heart failure", "cardio"], ["250.1", " lung disease ", "NA"],
                       ["250.12", "too fine", "x"], ["abc", "no code", "x"], ["10", 'kidney, "acute"\nor not', "renal"]])
    with open(folder / "candidates.csv", "w", newline="") as f:
        out = csv.writer(f)
        names = [h for h in CANDIDATE_HEADERS if h != "Form name"]
        out.writerow(names)
        for i in range(60):
            row = {"Variable accession": f"v{i}", "Variable name": f"{WORDS[i % 6]}_visit_{i % 4}",
                   "Variable description": f"{WORDS[i % 6]} measure {i}", "Study": f"S{i % 2}",
                   "Database": ["mesa", "whi", ""][i % 3], "Type": "null" if i % 5 else "num"}
            out.writerow([row.get(n, "") for n in names])
    return folder


@pytest.fixture(scope="module")
def retrieved(spark, files):
    settings = RetrievalSettings(min_candidates=3, max_candidates=6)
    out = str(files / "stage1")
    return run_retrieval(read_targets(spark, str(files / "targets.csv")),
                         read_candidates(spark, str(files / "candidates.csv")), settings, out, fmt="csv",
                         file_headers=True), out


def test_prepared_tables(spark, files):
    targets = prepare_targets(read_targets(spark, str(files / "targets.csv")), RetrievalSettings()).collect()
    assert [t.target_code for t in sorted(targets, key=lambda t: t.target_id)] == ["8", "8", "250.1", "10"]
    assert {t.target_text for t in targets} >= {"Phecode: 250.1. Phenotype: lung disease. Category: ."}
    first = prepare_targets(read_targets(spark, str(files / "targets.csv")),
                            RetrievalSettings(first_targets=1, target_codes=("8.0", "10"))).collect()
    assert [t.target_name for t in first] == ["heart disease"]
    candidates = prepare_candidates(read_candidates(spark, str(files / "candidates.csv")), RetrievalSettings())
    groups = {r.group: r.n for r in candidates.groupBy("group").agg(F.count("*").alias("n")).collect()}
    assert groups == {"mesa": 20, "whi": 20, "UNKNOWN_DATABASE": 20}
    assert candidates.where("form_name <> '' or type = 'null'").count() == 0
    with pytest.raises(ValueError, match="group column"):
        prepare_candidates(spark.createDataFrame([("a",)], "name string"), RetrievalSettings(group_column="region"))


def test_retrieval_run(spark, retrieved):
    result, out = retrieved
    rows = result.selected.collect()
    assert all(3 <= r.n_selected <= 6 and r.n_pool == 20 for r in rows)
    assert {r.scope for r in rows} == {"phecode_Database"} and {r.pass_label for r in rows} == {"not_hard_negative"}
    per_target = {}
    for r in rows:
        per_target.setdefault(r.target_id, []).append(r.target_rank)
    assert len(per_target) == 4 and all(sorted(v) == list(range(1, len(v) + 1)) for v in per_target.values())
    by_target = result.by_target.collect()
    assert len(by_target) == 4 and sum(r.target_code == "8" for r in by_target) == 2
    pooled = {r.n_candidates for r in by_target if r.target_code == "8"}
    assert pooled == {sum(r.target_code == "8" for r in rows)}
    assert sum(r.n_candidates for r in result.by_group.collect()) == len(rows)
    header = next(open(sorted(glob.glob(f"{out}/selected_csv/part-*.csv"))[0])).strip().split(",")
    assert {"phecode", "Variable name", "cosine_similarity", "step1_rank", "adaptive_threshold"} <= set(header)
    again = read_selected(spark, f"{out}/selected_csv", "csv")
    assert again.count() == len(rows) and {"target_code", "name", "score", "target_rank"} <= set(again.columns)


def replies_from(requests, fail=False):
    """A reply for each request: descriptions on the heart are the diagnosis, the rest is unrelated."""
    item = F.transform(
        F.from_json("payload", "array<struct<row_id: string, variable_description: string>>"),
        lambda x: F.struct(x["row_id"].alias("row_id"), F.lit("diagnosis").alias("clinical_category"),
                           F.when(x["variable_description"].contains("heart"), "exact_same").otherwise("unrelated")
                           .alias("relation_level"), F.lit("why").alias("reason")))
    text = F.to_json(F.struct(item.alias("results")))
    if fail:
        text = F.when(F.col("target_code") == "8", F.lit("the service is down")).otherwise(text)
    return requests.select("target_code", "batch_no", text.alias("reply"))


def test_labelling_run_and_resume(spark, retrieved, tmp_path):
    selected, out = retrieved[0].selected, str(tmp_path / "stage2")
    settings = LabelSettings(batch_size=5)
    n = selected.count()
    n_eight = selected.where("target_code = '8'").count()
    first = run_labelling(selected, settings, out, replies=lambda r: replies_from(r, fail=True),
                          inspect_codes=("8", "250.10", "77"), fmt="csv", file_headers=True)
    rows = first.ranked.collect()
    assert len(rows) == n and sum(r.label_status == "llm_failed" for r in rows) == n_eight
    assert {r.target_code for r in rows if r.label_status == "ok"} == {"250.1", "10"}
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{out}/inspect/target_code=*")) == ["250.1", "8"]

    calls = []

    def second_replies(requests):
        calls.extend(r.target_code for r in requests.collect())
        return replies_from(requests)

    second = run_labelling(selected, settings, out, replies=second_replies)
    assert set(calls) == {"8"}
    rows = second.ranked.collect()
    assert len(rows) == n and {r.label_status for r in rows} == {"ok"}
    assert all((r.label == "exact_diagnosis") == ("heart" in r.description) for r in rows)
    log = read_log(spark, f"{out}/log")
    assert next_run_seq(log) == 2 and log.count() == n + n_eight
    third = run_labelling(selected, settings, out, replies=replies_from)
    assert third.ranked.count() == n and read_log(spark, f"{out}/log").count() == n + n_eight
    same = label(spark.read.parquet(f"{out}/pairs"), read_log(spark, f"{out}/log"), settings)
    assert {(r.row_key, r.final_rank) for r in same.collect()} == {(r.row_key, r.final_rank) for r in rows}


def test_a_run_that_dies_loses_one_slice(spark, retrieved, tmp_path, monkeypatch):
    import pairwright.plans.labelling as labelling

    selected, out = retrieved[0].selected, str(tmp_path / "dying")
    settings = LabelSettings(batch_size=3, batches_per_commit=1)
    n, asked, real = selected.count(), [], labelling.append_log

    def replies(requests):
        asked.append(sum(r.n_rows for r in requests.select("n_rows").collect()))
        return replies_from(requests)

    def dies(results, path, run_seq):
        if sum(asked[:-1]) > 0 and asked[-1] > 0:  # its answers are written, but not logged
            raise RuntimeError("killed")
        real(results, path, run_seq)

    monkeypatch.setattr(labelling, "append_log", dies)
    with pytest.raises(RuntimeError):
        run_labelling(selected, settings, out, replies=replies)
    monkeypatch.setattr(labelling, "append_log", real)
    before = sum(asked)
    assert 0 < before < n and read_log(spark, f"{out}/log").count() < before
    asked.clear()
    rows = run_labelling(selected, settings, out, replies=replies).ranked.collect()
    assert sum(asked) == n - before and len(rows) == n and {r.label_status for r in rows} == {"ok"}
    assert read_log(spark, f"{out}/log").count() == n


def test_labelling_with_a_classifier_and_first_targets(spark, retrieved, tmp_path):
    def load():
        import json as js

        def answer(text):
            items = js.loads(text.rsplit("Variables:\n", 1)[1])
            return "```json\n" + js.dumps({"results": [
                {"row_id": i["row_id"], "clinical_category": "lab", "relation_level": "directly_related"}
                for i in items]}) + "\n```"
        return answer

    rows = run_labelling(retrieved[0].selected, LabelSettings(first_targets=1), str(tmp_path / "c"),
                         load_classifier=load).ranked.collect()
    assert {r.label for r in rows if r.target_code == "10"} == {"related_lab"}
    assert {(r.label_status, r.label) for r in rows if r.target_code != "10"} == {("missing", "unrelated")}
    with pytest.raises(ValueError):
        run_labelling(retrieved[0].selected, LabelSettings(), str(tmp_path / "d"))


def test_csv_round_trip_feeds_stage_two(spark, retrieved, tmp_path):
    selected = read_selected(spark, f"{retrieved[1]}/selected_csv", "csv")
    rows = run_labelling(selected, LabelSettings(), str(tmp_path / "e"), replies=replies_from).merged.collect()
    direct = run_labelling(retrieved[0].selected, LabelSettings(), str(tmp_path / "f"), replies=replies_from).merged.collect()
    assert {r.row_key for r in rows} == {r.row_key for r in direct}


def test_absent_log_is_empty_and_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_log(spark, path).count() == 0 and next_run_seq(read_log(spark, path)) == 0
    row = spark.createDataFrame(
        [("a", "lab", "exact_same", True, 1, "", "ok", "")],
        "row_key string, label_category string, label_relation string, label_keep boolean, label_priority int, "
        "label_reason string, label_status string, label_error string")
    append_log(row, path, 0)
    append_log(row.withColumn("label_status", F.lit("llm_failed")), path, 1)
    assert latest_results(read_log(spark, path)).first().label_status == "llm_failed"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("8", 'a "b", c\nd'), ("9", "x")], "target_code string, name string")
    write_table(df, str(tmp_path / "t"), "csv", file_headers=True)
    write_table(df.limit(1), str(tmp_path / "t"), "csv", file_headers=True)
    back = read_selected(spark, str(tmp_path / "t"), "csv").drop("input_order").collect()
    assert [tuple(r) for r in back] == [("8", 'a "b", c\nd')]
    write_inspection(df, str(tmp_path / "i"), ["008", "55"])
    assert [p.rsplit("=", 1)[1] for p in glob.glob(str(tmp_path / "i" / "target_code=*"))] == ["8"]


def test_custom_encoder(spark):
    def load():
        import numpy as np
        sizes = []

        def encode(texts):
            sizes.append(len(texts))
            assert max(sizes) <= 2
            return np.array([[len(t), 1.0] for t in texts])
        return encode

    df = spark.createDataFrame([("abc",), ("",), (None,), ("abcd",)], "text string").coalesce(1)
    rows = embed_with(df, "text", load, batch=2).collect()
    assert len(rows) == 4
    for r in rows:
        assert abs(sum(x * x for x in r.embedding) - 1) < 1e-6


def test_each_text_is_encoded_once(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import uuid

        import numpy as np

        def encode(texts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("".join(f"{t}\n" for t in texts))
            return np.array([[len(t), 1.0] for t in texts])
        return encode

    texts = ["a", "bb", None, "", "a", "ccc"] * 50
    df = spark.createDataFrame([(k, t, k) for k, t in enumerate(texts)], "id long, text string, more int").repartition(6)
    rows = embed_with(df, "text", load).collect()
    seen = [x for p in glob.glob(f"{folder}/*") for x in open(p).read().split("\n")[:-1]]
    assert sorted(seen) == ["", "a", "bb", "ccc"] and sorted(r.id for r in rows) == list(range(300))
    for r in rows:
        n = len(r.text or "")
        assert r.text == texts[r.id] and r.more == r.id and r.embedding == pytest.approx([n / (n * n + 1) ** 0.5, 1 / (n * n + 1) ** 0.5], abs=1e-6)


def test_inspection_of_a_code_with_many_rows(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "8").otherwise("9.1").alias("target_code"), (F.col("id") + 1).alias("final_rank"),
                                  F.lit('a "b", c').alias("target_name")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_inspection(df, str(tmp_path / "i"), ["8.0", "77"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = sorted(glob.glob(str(tmp_path / "i" / "target_code=8" / "part-*")))
    rows = [r for p in found for r in csv.DictReader(open(p, newline=""))]
    assert len(found) > 1 and [int(r["step2_rank"]) for r in rows] == [k + 1 for k in range(3000) if k % 3]
    assert {(r["phecode"], r["phenotype"]) for r in rows} == {("8", 'a "b", c')}
    assert not glob.glob(str(tmp_path / "i" / "target_code=9*"))


def test_cut_keeps_rows(spark):
    df = cut(spark.range(10))
    assert df.count() == 10 and spark.sparkContext.getCheckpointDir() is not None
    assert json.dumps([r.id for r in df.orderBy("id").collect()]) == json.dumps(list(range(10)))


def test_command_line(spark, files, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    main(["retrieve", "--targets", str(files / "targets.csv"), "--candidates", str(files / "candidates.csv"), "--out", one,
          "--min-candidates", "2", "--max-candidates", "4", "--inspect", "008", "--format", "csv"])
    n = spark.read.parquet(f"{one}/selected").count()
    assert n and spark.read.parquet(f"{one}/report/sample").where("target_code <> '8'").count() == 0
    assert spark.read.parquet(f"{one}/report/target_buckets").first().over_20 == 0
    main(["requests", "--selected", f"{one}/selected_csv", "--selected-format", "csv", "--out", two])
    requests = spark.read.parquet(f"{two}/requests/run_seq=0")
    write_table(replies_from(requests), str(tmp_path / "replies"))
    main(["label", "--selected", f"{one}/selected_csv", "--selected-format", "csv", "--out", two,
          "--replies", str(tmp_path / "replies")])
    ranked = spark.read.parquet(f"{two}/ranked")
    assert ranked.count() == n and ranked.where("label_status <> 'ok'").count() == 0
    assert spark.read.parquet(f"{two}/report/by_target").agg(F.sum("n_candidates")).first()[0] == n


def test_inputs_as_parquet_and_split_csv(spark, tmp_path):
    rows = [(f"{k}", f"name {k}", "c") for k in range(20)]
    df = spark.createDataFrame(rows, "phecode string, phenotype string, category string")
    df.write.parquet(str(tmp_path / "p"))
    df.write.option("header", True).csv(str(tmp_path / "c"))
    frames = [read_targets(spark, str(tmp_path / "p"), "parquet"), read_targets(spark, str(tmp_path / "c"), multi_line=False)]
    ids = [{(r.target_code, r.target_id) for r in prepare_targets(f, RetrievalSettings()).collect()} for f in frames]
    assert ids[0] == ids[1] and len(ids[0]) == 20


def test_ranked_output_is_in_order(spark, tmp_path):
    df = spark.range(200).select(F.concat(F.lit("t"), F.col("id") % 7).alias("target_code"), (200 - F.col("id")).alias("final_rank")).repartition(5)
    write_table(df, str(tmp_path / "o"), "csv", order=("target_code", "final_rank", "absent"))
    lines = [x for p in sorted(glob.glob(str(tmp_path / "o" / "part-*"))) for x in open(p).read().split("\n")[1:] if x]
    found = [(a, int(b)) for a, b in (x.split(",") for x in lines)]
    assert found == sorted(found) and len(found) == 200


def test_supplied_vectors_are_brought_to_norm_one(spark):
    targets = spark.createDataFrame([(0, [3.0, 4.0])], "target_id long, embedding array<float>")
    candidates = spark.createDataFrame([(k, "g", [k + 1.0, 10.0]) for k in range(5)], "cand_id long, group string, embedding array<float>")
    scores = [r.score for r in retrieve(targets, candidates, RetrievalSettings(unit_vectors=True)).collect()]
    assert len(scores) == 5 and max(scores) <= 1 + 1e-6
