import hashlib
import random
from collections import Counter

import pytest

from pairwright.llm.repeats import remove_repeats
from tests.llm.hostile import CLASHING


def plain_removal(rows, length):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for doc, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                mask[k:k + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mask, strict=True) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and (k == 0 or not mask[k - 1]))
        out.append((doc, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, length, gram):
    extra = ", ".join(f"`{c}` int" for c in CLASHING)
    docs = spark.createDataFrame([(*r, *range(len(CLASHING))) for r in rows], f"doc_id long, text string, {extra}")
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs, length, gram).collect()), key=repr)


@pytest.mark.parametrize(("length", "gram"), [(40, 20), (40, 8), (25, 12)])
def test_equals_plain_removal(spark, length, gram):
    rng = random.Random(length + gram)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [text(rng.randrange(10, 120)) for _ in range(8)]
    rows = [(i, "".join(rng.choice([rng.choice(shared), text(rng.randrange(30))]) for _ in range(rng.randrange(7)))) for i in range(100)]
    rows += [(200, None), (201, ""), (202, "a" * 300), (203, "ab" * 100), (None, rows[5][1]), (None, rows[5][1]), (7, rows[7][1]), (7, text(90)), (205, shared[0] * 2)]
    assert run(spark, rows, length, gram) == plain_removal(rows, length)


def test_one_passage_in_many_contexts(spark, monkeypatch):
    """More runs in one bucket than are compared at once."""
    import pairwright.llm.repeats as repeats

    monkeypatch.setattr(repeats, "BUCKET", 8)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = text(70)
    rows = [(i, text(rng.randrange(40)) + passage[rng.randrange(20):50 + rng.randrange(20)] + text(rng.randrange(40))) for i in range(150)]
    assert run(spark, rows, 40, 20) == plain_removal(rows, 40)


def test_long_texts_are_cut_into_stretches(spark, monkeypatch):
    import pairwright.llm.repeats as repeats

    assert [*repeats.stretches(399, 400)] == [] and [*repeats.stretches(400, 400)] == [(0, 400)]
    step = (1 << 20) - 400
    ends = [*repeats.stretches(3 * step, 400)]
    assert ends[0] == (0, step + 399) and ends[1][0] == step and ends[-1][1] == 3 * step
    rng = random.Random(10)
    long = "".join(rng.choice("abcdefghijklmnop") for _ in range(step + 3000))
    rows = [(1, long), (2, "x" * 10 + long[step - 700:step + 900] + "y" * 10)]
    got = run(spark, rows, 400, 200)
    kept = {1: long[:step - 700] + long[step + 900:], 2: "x" * 10 + "y" * 10}
    assert got == [(i, len(t), 1600, 1, hashlib.sha256(kept[i].encode()).hexdigest()) for i, t in rows]


def test_empty_table(spark):
    assert run(spark, [], 40, 20) == []


def test_texts_are_shuffled_once(spark):
    """Both joins read the one shuffle of the packed texts."""
    rows = spark.range(400).selectExpr("id as doc_id", "concat(repeat('shared text ', 10), sha2(string(id % 50), 512), id) as text")
    found = remove_repeats(rows, 40, 20)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().finalPhysicalPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    texts = [line for line in plan.splitlines() if "Exchange" in line and "packed" in line]
    assert sum("ReusedExchange" in line for line in texts) == 1
    assert plan.count("MapInArrow _pack(") == 1
