import random
import re

import numpy as np
import pytest
import xxhash

from pairwright.llm import simhash as S
from pairwright.llm.components import components
from tests.llm.hostile import documents, empty, hostile_texts, prose


def plain_fingerprint(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(values, linked):
    root = list(range(len(values)))
    for a in range(len(values)):
        for b in range(a):
            if linked(values[a], values[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return root


@pytest.mark.parametrize("blocks", [5, 6, 8])
def test_fingerprints_and_components(spark, blocks):
    rng = random.Random(4)
    base = prose(rng, 400)
    texts = hostile_texts() + [prose(rng, 50) for _ in range(20)]
    for _ in range(30):
        words = base.split()
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(400)] = f"x{rng.randrange(99)}"
        texts.append(" ".join(words).title())
    fps = [plain_fingerprint(t, 4) for t in texts]
    want = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in S.near_fingerprints(documents(spark, texts), 4, 4, blocks=blocks).collect()}
    assert got == {i: (f, w) for i, (f, w) in enumerate(zip(fps, want, strict=True))}
    assert 1 < len(set(want)) < len(set(fps))


def test_forest_joins_what_all_links_join():
    rng = np.random.default_rng(1)
    near = (1 << rng.integers(0, 64, (400, 3), dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    values = np.unique(np.concatenate([near, rng.integers(0, 1 << 63, 50, dtype=np.uint64)]))
    want = plain_components([int(v) for v in values], lambda a, b: (a ^ b).bit_count() <= 4)
    root = list(range(len(values)))
    left, right = S.forest(values, 4)
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = [new if r == old else r for r in root]
    assert root == want and len(left) == len(values) - len(set(want))
    order = rng.permutation(len(values))
    again = S.forest(values[order], 4)
    pairs = lambda v, links: sorted(zip(v[links[0]].tolist(), v[links[1]].tolist(), strict=True))
    assert pairs(values[order], again) == pairs(values, (left, right))


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(0, 300) if k % 50 != 49] + [(1000, k) for k in range(1001, 1100)] + [(5, 5), (7, 6)]
    root = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert root == {k: k // 50 * 50 for k in range(300) if k % 50} | {k: 1000 for k in range(1001, 1100)}


def near_copies(rng, groups=8, copies=4):
    """Texts whose fingerprints mostly lie within a few bits of each other in each group."""
    texts = []
    for _ in range(groups):
        base = prose(rng, 600, 10**6).split()
        texts.append(" ".join(base))
        for _ in range(copies):
            words = list(base)
            words[rng.randrange(600)] = "changed"
            texts.append(" ".join(words))
    return texts


def test_one_row_of_each_component_stays(spark):
    texts = hostile_texts() + near_copies(random.Random(6))
    docs = documents(spark, texts)
    got = {r.doc_id: r.component_id for r in S.near_fingerprints(docs).collect()}
    assert got[0] == got[1] == got[2] == 0 and got[4] == got[5] == got[6] == 4
    assert len(set(got.values())) < len(texts) - 12
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert all(r.text == texts[r.doc_id] for r in kept.collect())
    twice = S.keep_one(docs.union(docs))
    assert sorted(r.doc_id for r in twice.collect()) == sorted(set(got.values()))
    assert S.keep_one(empty(docs)).collect() == [] and S.near_fingerprints(empty(docs)).collect() == []


def test_rows_not_ids_are_kept(spark):
    """Different texts with one id both stay; equal texts without an id are one."""
    rng = random.Random(7)
    one, two, three = (prose(rng, 80) for _ in range(3))
    rows = [(5, one, 1), (5, two, 2), (None, three, 3), (None, three, 4), (None, one, 5), (9, two, 6), (9, two, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `_first` int")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.text, r["_first"]) for r in S.keep_one(docs).collect())
    assert [r[:3] for r in found] == sorted([(False, 5, one), (False, 5, two), (True, 0, three)]) and found[-1][3] in (3, 4)
    assert found == sorted((r.doc_id is None, r.doc_id or 0, r.text, r["_first"]) for r in S.keep_one(docs.repartition(3)).collect())


@pytest.mark.parametrize("copies", [10, 2000])
def test_a_group_of_any_size_sends_a_link_for_each_member(spark, copies):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    near = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (copies, 2))} | {base})
    rows = [((v - (1 << 64) if v >> 63 else v),) for v in near]
    links = S.near_links(spark.createDataFrame(rows, "fp long"), 4, 6).collect()
    assert len(links) <= 6 * len(near)
    root = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({root.get(v[0], v[0]) for v in rows}) == 1
