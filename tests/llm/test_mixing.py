from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pairwright.llm import mixing
from tests.llm.hostile import documents, empty, hostile_texts, prose
import random
import re


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by plain rounds of sharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, left = sum(sizes.values()), {}, dict(weight)
    while left:
        level = (total - sum(target.values())) / sum(left.values())
        stop = [s for s in left if most * sizes[s] < level * left[s]]
        if not stop:
            target |= {s: level * w for s, w in left.items()}
            break
        for s in stop:
            target[s] = most * sizes[s]
            del left[s]
    return target


def check(rows, texts, sources):
    sizes = defaultdict(int)
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    for n, s in zip(size, sources, strict=True):
        sizes[s] += n
    want, taken = shares(sizes), defaultdict(int)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == sizes[sources[r.doc_id]]
        assert r.target == pytest.approx(want[sources[r.doc_id]], rel=1e-9)
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[sources[r.doc_id]] += r.taken
    return want, taken, sizes


def test_targets_are_met_and_reruns_agree(spark):
    rng = random.Random(1)
    texts = [prose(rng, rng.choice([3, 30, 200, 1500])) for _ in range(400)]
    sources = [rng.choice(["a", "b", "b", "b", "B", "é", None, "tiny"]) for _ in texts]
    texts = [prose(rng, 5) if s == "tiny" else t for t, s in zip(texts, sources, strict=True)]
    docs = documents(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    want, taken, sizes = check(rows, texts, sources)
    for s in want:
        assert abs(taken[s] - want[s]) <= max(60, 0.01 * want[s])
    assert want["tiny"] == 3 * sizes["tiny"] == taken["tiny"]
    assert {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(3)).collect()} == {(r.doc_id, r.taken) for r in rows}


def test_hostile_rows_and_repeats(spark):
    texts = hostile_texts()
    sources = [None if i % 4 == 0 else "s" for i in range(len(texts))]
    docs = documents(spark, texts, sources)
    check(mixing.mix(docs).collect(), texts, sources)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    found = defaultdict(int)
    for r in mixed.collect():
        found[r.doc_id] += 1
        assert r.text == texts[r.doc_id]
    assert found == {k: n for k, n in copies.items() if n}
    assert mixing.mix(empty(docs)).collect() == [] and mixing.mixed_rows(empty(docs)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = documents(spark, ["a b", "c d e"], ["x", "y"])
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan


def test_rows_that_share_an_id_and_names_used_inside(spark):
    rng = random.Random(3)
    names = ("_id", "_n", "_source", "_size", "_copies", "_copy", "_first", "_second", "first", "second", "more", "copies", "pile")
    rows = [(None if k % 5 == 0 else k % 7, prose(rng, 1 + k % 40), "s" if k % 3 else None, *[k + j for j in range(len(names))]) for k in range(60)]
    rows += rows[:4] + [(3, None, "s", *range(len(names))), (3, "", "s", *range(len(names)))]
    extra = ", ".join(f"`{c}` int" for c in names)
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {extra}")
    made = [tuple(r) for r in mixing.mixed_rows(docs).collect()]
    assert set(made) <= set(rows) and {r for r in rows if not (r[1] or "").split()} <= set(made)
    assert all(made.count(r) <= 3 * rows.count(r) for r in set(made))
    wanted, size = defaultdict(int), lambda r: len((r[1] or "").split())
    for r in mixing.mix(docs).collect():
        wanted[r.source] += r.taken
    taken = defaultdict(int)
    for r in made:
        taken[r[2]] += size(r)
    assert taken == wanted
    assert sorted(map(repr, made)) == sorted(repr(tuple(r)) for r in mixing.mixed_rows(docs.repartition(3)).collect())


def test_many_copies_are_written_in_piles(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PILE", 7)
    docs = documents(spark, ["a b c"] * 3, ["x"] * 3).select("text", "source", F.lit(1).cast("long").alias("doc_id"))
    docs = docs.union(docs).union(docs)
    rows = mixing.mixed_rows(docs).collect()
    assert len(rows) == sum(r.copies for r in mixing.mix(docs).collect()) and {tuple(r) for r in rows} == {("a b c", "x", 1)}
