"""Keys, batches, replies, merge and ranks on small fixtures."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairwright.operators.keys import with_content_key
from pairwright.operators.merge import final_rank, merge_labels
from pairwright.operators.pairs import first_targets, keep_passed, load_pairs, top_per_target
from pairwright.operators.ranking import spread_row_number
from pairwright.operators.replies import ask, classify, parse_replies, stray_items, validate_items
from pairwright.operators.requests import assign_batches, build_requests, target_headers
from pairwright.settings import LabelSettings
from pairwright.streaming.runlog import latest_results, pending

S = LabelSettings()
PAIR = "target_code string, target_name string, target_category string, accession string, name string, description string"


def parse(spark, *texts):
    df = spark.createDataFrame([("1", i, t) for i, t in enumerate(texts)],
                               "target_code string, batch_no bigint, reply string")
    return parse_replies(df).orderBy("batch_no").collect()


def reply(*items):
    return json.dumps({"results": list(items)})


def test_reply_shapes(spark):
    item = '{"row_id": "a", "clinical_category": "lab", "relation_level": "exact_same", "reason": "r"}'
    good = f'{{"results": [{item}]}}'
    read = [good, f"```json\n{good}\n```", f"```\n{good}```", f"Sure: {good} done", f"  {good}\n", f"```JSON\n{good}\n```"]
    for row in parse(spark, *read):
        assert row.reply_error is None and [i.row_id for i in row["items"]] == ["a"]
    failed = {
        f"[{item}]": "list", f"[{good}]": "list", "{}": "list", '{"results": null}': "list",
        '{"results": {"a": 1}}': "list", '{"results": "x"}': "list", '{"results": []}': "empty",
        f'{{"results": [{item}, 5]}}': "object", '{"results": [null]}': "object", "nonsense": "JSON", "": "JSON",
        '{"results": [': "JSON", "} {": "JSON",
    }
    for row, why in zip(parse(spark, *failed), failed.values()):
        assert why in row.reply_error and row["items"] is None, row
    assert parse(spark, None)[0].reply_error == "no reply"


def test_item_validation(spark):
    cases = [
        ({"row_id": "a", "clinical_category": " LAB ", "relation_level": "Directly_Related", "reason": " a \n b "},
         ("a", "lab", "directly_related", True, 2, "a b")),
        ({"row_id": "a", "relation_level": "exact_same"}, ("a", "unrelated", "exact_same", True, 1, "")),
        ({"row_id": "a", "clinical_category": None, "relation_level": "exact_same"},
         ("a", "other", "exact_same", True, 1, "")),
        ({"row_id": "a", "clinical_category": "lab", "relation_level": "related"},
         ("a", "unrelated", "unrelated", False, 4, "")),
        ({"row_id": "a", "clinical_category": "lab", "relation_level": None},
         ("a", "unrelated", "unrelated", False, 4, "")),
        ({"row_id": "a", "clinical_category": "lab", "relation_level": "unrelated", "keep": True, "priority": 1},
         ("a", "unrelated", "unrelated", False, 4, "")),
        ({"row_id": "a", "clinical_category": "unrelated", "relation_level": "directly_related"},
         ("a", "unrelated", "directly_related", True, 2, "")),
        ({"row_id": 7, "clinical_category": "zzz", "relation_level": "clinically_relevant"},
         ("7", "other", "clinically_relevant", True, 3, "")),
        ({"relation_level": "exact_same", "clinical_category": "diagnosis", "reason": None},
         ("", "diagnosis", "exact_same", True, 1, "None")),
    ]
    df = spark.createDataFrame([("1", i, reply(c)) for i, (c, _) in enumerate(cases)],
                               "target_code string, batch_no bigint, reply string")
    got = validate_items(parse_replies(df)).orderBy("batch_no").drop("target_code", "batch_no", "item_no").collect()
    assert [tuple(r) for r in got] == [want for _, want in cases]


def requests_df(spark, *batches):
    return spark.createDataFrame(batches, "target_code string, batch_no bigint, row_keys array<string>")


def replies_df(spark, *rows):
    return spark.createDataFrame(rows, "target_code string, batch_no bigint, reply string, error string")


def ok(key, relation="exact_same", category="diagnosis"):
    return {"row_id": key, "relation_level": relation, "clinical_category": category, "reason": "x"}


def test_classify_gives_each_row_one_result(spark):
    asked = requests_df(spark, ("1", 0, ["a", "b", "c"]), ("1", 1, ["d"]), ("2", 0, ["e"]), ("2", 1, ["f"]))
    replies = replies_df(
        spark,
        ("1", 0, reply(ok("a"), ok("b"), ok("b", "unrelated"), ok("zz"), ok("d")), None),
        ("1", 1, "broken", None),
        ("2", 0, None, "time out"))
    rows = {r.row_key: r for r in classify(asked, replies, S).collect()}
    assert {k: r.label_status for k, r in rows.items()} == {
        "a": "ok", "b": "ok", "c": "missing_from_llm_output", "d": "llm_failed", "e": "llm_failed", "f": "llm_failed"}
    assert rows["b"].label_relation == "unrelated" and not rows["b"].label_keep
    assert rows["e"].label_error == "time out" and rows["e"].label_reason.endswith("Error: time out")
    assert rows["f"].label_error == "no reply"
    assert rows["c"].label_reason == "Missing from LLM output; assigned unrelated fallback."
    strays = stray_items(asked, parse_replies(replies)).collect()
    assert sorted(r.row_key for r in strays) == ["d", "zz"]
    with pytest.raises(Exception, match="batch failed"):
        classify(asked, replies, LabelSettings(on_error="raise")).collect()


def test_ask_fails_one_batch_only(spark):
    def load():
        def answer(text):
            if "bad" in text:
                raise RuntimeError("no service")
            return '{"results": [{"row_id": "%s"}]}' % text
        return answer

    asked = spark.createDataFrame([("1", 0, "a"), ("1", 1, "bad")], "target_code string, batch_no bigint, request string")
    rows = {r.batch_no: r for r in ask(asked, load).collect()}
    assert json.loads(rows[0].reply)["results"][0]["row_id"] == "a"
    assert rows[1].reply is None and rows[1].error == "no service"


@pytest.mark.parametrize("marks, kept", [
    ([None, None], 2), (["0", "no"], 2), (["1", "0", None], 1), (["TRUE", "Yes", "1.0", "false"], 3)])
def test_pass_filter_is_permissive(spark, marks, kept):
    df = spark.createDataFrame([(m,) for m in marks], "passed string")
    assert keep_passed(df).count() == kept


def pairs(spark, rows, extra="score string", settings=S):
    return load_pairs(spark.createDataFrame(rows, f"{PAIR}, {extra}"), settings)


def test_load_pairs(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        load_pairs(spark.createDataFrame([("1",)], "target_code string"), S)
    rows = pairs(spark, [("08.0", " n ", "c", "a", "LDL_v2", "d", "0.5"), ("", "n", "c", "b", "x", "d", "NaN"),
                         (None, "n", "c", "c", "x", "d", "bad")]).collect()
    assert {r.accession: (r.target_code, r.score) for r in rows} == {"a": ("8", 0.5), "b": (None, None), "c": (None, None)}
    kept = pairs(spark, [("8", "n", "c", "a", "x", "d", "1"), ("9", "n", "c", "a", "x", "d", "1")],
                 settings=LabelSettings(target_codes=("008",))).collect()
    assert [r.target_code for r in kept] == ["8"]


def test_top_n_keeps_rows_without_a_code(spark):
    rows = [("8", "n", "c", f"a{i}", "x", "d", str(i / 10)) for i in range(6)] + [("8", "n", "c", "z", "x", "d", None)]
    rows += [(None, "n", "c", "q", "x", "d", "1")]
    got = pairs(spark, rows, settings=LabelSettings(top_n=2)).collect()
    assert sorted(r.accession for r in got) == ["a4", "a5", "q"]


def test_content_keys_of_copies_and_variants(spark):
    rows = [("a", 1)] * 5 + [("a", 2)] * 2 + [("b", 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    keyed = with_content_key(df, ["k"], "key").collect()
    assert set(with_content_key(df, ["k"], "key").columns) == {"k", "v", "key"}
    assert len(keyed) == 8 and len({r.key for r in keyed}) == 8
    assert Counter((r.k, r.v) for r in keyed) == Counter(rows)
    again = with_content_key(df.repartition(5).orderBy("v"), ["k"], "key").collect()
    assert {r.key for r in again} == {r.key for r in keyed}
    other = with_content_key(df.where("k = 'b'"), ["k"], "key").first().key
    assert other in {r.key for r in keyed}
    for gone in (1, 2):  # a key does not move when another variant goes
        left = {r.key for r in with_content_key(df.where(F.col("v") != gone), ["k"], "key").collect()}
        assert left == {r.key for r in keyed if r.v != gone}


def test_piles_of_copies_keep_their_keys(spark, monkeypatch):
    df = spark.range(25).select(F.lit("a").alias("k"))
    whole = {r.key for r in with_content_key(df, ["k"], "key").collect()}
    monkeypatch.setattr("pairwright.operators.keys._COPIES_PER_PILE", 4)
    assert {r.key for r in with_content_key(df, ["k"], "key").collect()} == whole and len(whole) == 25


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_batches(spark, limit):
    settings = LabelSettings(batch_size=4, window_rows=limit)
    rows = [("8", f"name{i}", "c", f"a{i}", "x", "d", None if i % 5 == 0 else str((i * 7 % 11) / 10)) for i in range(23)]
    rows += [("9", "n", "c", f"b{i}", "x", "d", "0.5") for i in range(5)] + [(None, "n", "c", "q", "x", "d", "1")]
    loaded = pairs(spark, rows)
    batched = assign_batches(loaded, settings)
    found = batched.collect()
    assert len(found) == 28
    for code in ("8", "9"):
        mine = sorted((r for r in found if r.target_code == code), key=lambda r: r.position)
        assert mine == sorted(mine, key=lambda r: (-(r.score if r.score is not None else -9), r.row_key))
        assert [r.position for r in mine] == list(range(1, len(mine) + 1))
        assert [r.batch_no for r in mine] == [(p - 1) // 4 for p in range(1, len(mine) + 1)]
    requests = build_requests(batched, target_headers(loaded), settings).collect()
    assert sum(r.n_rows for r in requests) == 28 and max(r.n_rows for r in requests) == 4
    best = min((r for r in found if r.target_code == "8"), key=lambda r: r.position)
    for r in requests:
        items = json.loads(r.payload)
        assert [i["row_id"] for i in items] == r.row_keys
        assert len(items[0]) == 18 and r.payload in r.request
        if r.target_code == "8":
            assert r.target_name == best.target_name and f"Target name: {best.target_name}\n" in r.request
    nulls = [i for r in requests for i in json.loads(r.payload) if i["cosine_similarity"] is None]
    assert len(nulls) == 5


def test_spread_row_number_with_hot_ties(spark):
    df = spark.range(3_000).select(
        F.lit("hot").alias("k"), F.when(F.col("id") < 1_000, 0.5).otherwise(F.col("id") / 3_000).alias("score"),
        F.sha2(F.col("id").cast("string"), 256).alias("row_key"))
    order = [F.desc("score"), F.col("row_key")]
    got = spread_row_number(df, ["k"], [[-F.floor(F.col("score") * 64)],
                                        [-F.col("score"), F.substring("row_key", 1, 2)]], order, "n").collect()
    want = sorted(got, key=lambda r: (-r.score, r.row_key))
    assert [r.n for r in want] == list(range(1, 3_001))


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_ranks_of_infinite_and_missing_scores(spark, limit):
    scores = [float("-inf"), float("inf"), None, 0.5, 0.5, -3e300, 3e300, -0.0, 1e-9]
    rows = [(f"k{i}", "8", x) for i, x in enumerate(scores)]
    df = spark.createDataFrame(rows, "row_key string, target_code string, score double")
    got = [r.row_key for r in sorted(assign_batches(df, LabelSettings(window_rows=limit)).collect(), key=lambda r: r.position)]
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0) if r[2] is not None else 0, r[0]))
    assert got == [r[0] for r in want]


def test_two_replies_to_a_batch_count_once(spark):
    requests = spark.createDataFrame([("8", 0, ["a", "b"]), ("9", 0, ["c"])], "target_code string, batch_no long, row_keys array<string>")
    good = json.dumps({"results": [{"row_id": "a", "clinical_category": "lab", "relation_level": "unrelated"}]})
    replies = [("8", 0, "broken"), ("8", 0, good), ("8", 0, good), ("8", 0, None), ("9", 0, None), ("9", 0, "[]")]
    for order in (replies, replies[::-1]):
        got = classify(requests, spark.createDataFrame(order, "target_code string, batch_no long, reply string"), LabelSettings()).collect()
        assert sorted((r.row_key, r.label_status) for r in got) == [("a", "ok"), ("b", "missing_from_llm_output"), ("c", "llm_failed")]


def test_ties_in_the_log_have_one_winner(spark):
    rows = [("a", "lab", "unrelated", False, 4, "", "llm_failed", "x", 1), ("a", "lab", "exact_same", True, 1, "", "ok", "", 1),
            ("a", "lab", "directly_related", True, 1, "", "ok", "", 1), ("a", "other", "exact_same", True, 1, "", "ok", "", 0)]
    for order in (rows, rows[::-1]):
        (r,) = latest_results(spark.createDataFrame(order, LOG)).collect()
        assert (r.label_category, r.label_relation, r.label_status) == ("lab", "exact_same", "ok")


def test_first_targets(spark):
    df = spark.createDataFrame([("b", 1), ("a", 5), ("b", 9), ("c", 2), (None, 0)], "target_code string, pos int")
    assert {r.target_code for r in first_targets(df, 2, F.col("pos")).collect()} == {"b", "c"}
    assert {r.target_code for r in first_targets(df, 1).collect()} == {"a"}


LOG = ("row_key string, label_category string, label_relation string, label_keep boolean, label_priority int, "
       "label_reason string, label_status string, label_error string, run_seq bigint")


def log_row(key, status, seq, relation="exact_same", category="diagnosis"):
    return (key, category, relation, relation != "unrelated", 1, "", status, "", seq)


def test_log_keeps_the_last_row_and_resumes(spark):
    log = spark.createDataFrame([
        log_row("a", "ok", 0), log_row("a", "llm_failed", 1), log_row("a", "ok", 2),
        log_row("b", "llm_failed", 0), log_row("b", "ok", 1), log_row("c", "ok", 0), log_row("c", "llm_failed", 1),
        log_row("d", "missing_from_llm_output", 0)], LOG)
    assert {r.row_key: r.label_status for r in latest_results(log).collect()} == {
        "a": "ok", "b": "ok", "c": "llm_failed", "d": "missing_from_llm_output"}
    rows = spark.createDataFrame([(k,) for k in "abcde"], "row_key string")

    def left(**options):
        return sorted(r.row_key for r in pending(rows, log, LabelSettings(**options)).collect())

    assert left() == ["c", "d", "e"]
    assert left(retry_failed=False) == ["e"]
    assert left(resume=False) == list("abcde")
    empty = spark.createDataFrame([], LOG)
    assert pending(rows, empty, S).count() == 5


def test_merge_and_final_rank(spark):
    given = [("8", "n", "c", f"a{i}", "x", "d", s) for i, s in enumerate(["0.9", None, "0.5", "0.7", "NaN"])]
    loaded = pairs(spark, given + [(None, "n", "c", "q", "x", "d", "1")])
    key = {r.accession: r.row_key for r in loaded.collect()}
    labels = spark.createDataFrame([
        log_row(key["a0"], "ok", 0, "clinically_relevant", "lab"), log_row(key["a1"], "ok", 0),
        log_row(key["a2"], "ok", 0, "directly_related", "unrelated"), log_row(key["a3"], "llm_failed", 0, "unrelated", "unrelated")],
        LOG)
    for limit in (1_000_000, 1):
        settings = LabelSettings(window_rows=limit)
        rows = {r.accession: r for r in final_rank(merge_labels(loaded, labels, settings), settings).collect()}
        assert len(rows) == 6
        assert rows["a1"].label == "exact_diagnosis" and rows["a1"].is_exact_diagnosis
        assert rows["a0"].label == "relevant_lab" and rows["a0"].is_related_lab
        assert rows["a2"].label == "related_unrelated" and rows["a2"].category_rank == 99
        assert rows["a4"].label_status == "missing" and rows["a4"].label_priority == 4 and rows["a4"].score is None
        assert rows["q"].final_rank is None
        ranks = [rows[f"a{i}"].final_rank for i in range(5)]
        assert sorted(ranks) == [1, 2, 3, 4, 5] and rows["a4"].final_rank == 5
        by_rule = sorted(("a0", "a1", "a2", "a3"), key=lambda a: (
            rows[a].label_priority, rows[a].relation_rank, rows[a].category_rank, -(rows[a].score or -9)))
        assert [rows[a].final_rank for a in by_rule] == [1, 2, 3, 4]
    filled = merge_labels(loaded, labels, LabelSettings(fill_score=-999.0))
    assert {r.accession: r.score for r in filled.collect()}["a4"] == -999.0
    bare = merge_labels(loaded, labels.select("row_key", "label_category", "label_relation", "label_keep", "label_reason"), S)
    assert {r.label_status for r in bare.collect()} == {"unknown"}


def test_headers_of_a_code_with_many_batches(spark, monkeypatch):
    from pairwright.operators import requests

    monkeypatch.setattr(requests, "_BATCHES_PER_COPY", 3)
    rows = spark.range(90).select(F.concat(F.lit("k"), F.col("id")).alias("row_key"), F.when(F.col("id") < 60, "8").otherwise("9").alias("target_code"),
                                  F.lit("n").alias("target_name"), F.lit("c").alias("target_category"), (F.col("id") / 100).alias("score"),
                                  F.lit(1).alias("target_rank"), *[F.lit("").alias(c) for _, c in requests.REQUEST_FIELDS if c not in ("row_key", "score", "target_rank")])
    settings = LabelSettings(batch_size=2)
    made = build_requests(assign_batches(rows, settings), target_headers(rows), settings).collect()
    assert sorted((r.target_code, r.batch_no) for r in made) == [("8", k) for k in range(30)] + [("9", k) for k in range(15)]
    assert sum(r.n_rows for r in made) == 90 and all("Target name: n" in r.request for r in made)


def test_keys_of_small_and_large_tables_agree(spark, monkeypatch):
    from pairwright.operators import keys

    rows = [(f"k{i % 40}", f"v{i % 7}", "long text" if i % 3 else f"d{i}") for i in range(200)] + [("x", None, None)] * 5
    df = spark.createDataFrame(rows, "k string, v string, description string")
    found = []
    for limit in (1 << 30, 0):
        monkeypatch.setattr(keys, "_SMALL_BYTES", limit)
        found.append(sorted(map(repr, with_content_key(df, ["k", "description"], "key").collect())))
    assert found[0] == found[1] and len(set(found[0])) == 205
