import random

import numpy as np

from pairwright.llm import decontaminate as D
from tests.llm.hostile import documents, empty, hostile_texts, prose


def plain_align(item, text):
    """Smith-Waterman, cell by cell."""
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        now = [0]
        for k, b in enumerate(text):
            now.append(max(0, above[k] + (D.MATCH if a == b else D.MISMATCH), above[k + 1] + D.GAP, now[k] + D.GAP))
        best, above = max(best, *now), now
    return best


def test_alignment_equals_the_plain_one():
    rng = random.Random(2)
    for _ in range(100):
        item = [rng.randrange(5) for _ in range(rng.randrange(1, 12))]
        text = [rng.randrange(-1, 5) for _ in range(rng.randrange(1, 20))]
        assert D.align(np.array(item), np.array([text]))[0] == plain_align(item, text)


def test_finds_copies_and_edited_ones_only(spark):
    rng = random.Random(3)
    items = [prose(rng, 30) for _ in range(6)]
    edited = items[1].split()
    for k in (4, 11, 19, 26):
        edited[k] = "changed"
    del edited[8]
    texts = [prose(rng, 200) for _ in range(40)]
    texts[3] += " " + items[0].upper().replace(" ", ", ") + "! " + prose(rng, 50)
    texts[4] = prose(rng, 20) + " " + " ".join(edited)
    texts[5] = items[2]
    texts[6] = " ".join(items[3].split()[:10])
    texts[7] = prose(rng, 9) + " " + items[5]
    table = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (None, items[5]), (0, items[0])], "item_id long, text string")
    docs = documents(spark, texts)
    for block in (10**6, 40):
        found = D.contaminated(docs, table, block_grams=block).collect()
        assert {(r.doc_id, r.item_id) for r in found} == {(3, 0), (4, 1), (5, 2), (7, 5), (7, None)}
    items = {None: items[5], **dict(enumerate(items))}
    words = {i: D.normal(t).split() for i, t in enumerate(texts)}
    for r in found:
        assert r.words == plain_align(D.normal(items[r.item_id]).split(), words[r.doc_id])
    kept = D.clean(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(40)) - {3, 4, 5, 7}


def test_excerpts_and_heavy_edits(spark):
    """240 of 500 words, and copies of 60 words of which every third is another; unrelated texts stay."""
    rng = random.Random(11)
    item, short = prose(rng, 500), prose(rng, 60).split()
    edited = [w if k % 3 else "changed" for k, w in enumerate(short)]
    blocks = [w for k in range(0, 60, 6) for w in [*short[k:k + 4], "other", "words"]]
    texts = [prose(rng, 300) for _ in range(60)]
    texts[1] += " " + " ".join(item.split()[130:370])
    texts[2] = prose(rng, 40) + " " + " ".join(blocks) + " " + prose(rng, 40)
    docs = documents(spark, texts)
    table = spark.createDataFrame([(None, item), (None, " ".join(short))], "item_id long, text string")
    found = D.contaminated(docs, table).collect()
    assert {r.doc_id for r in found} == {1, 2} and max(r.words for r in found) == 240 and {r.item_id for r in found} == {None}
    assert {r.doc_id for r in D.clean(docs, table).collect()} == set(range(60)) - {1, 2}
    assert plain_align(short, edited) >= D.STRETCH


def test_hostile_rows(spark):
    docs = documents(spark, hostile_texts())
    table = spark.createDataFrame([(1, hostile_texts()[4]), (2, "a"), (3, None)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.contaminated(docs, table).collect()} == {(3, 2), (4, 1), (5, 1), (6, 1)}
    assert D.contaminated(empty(docs), table).collect() == [] and D.contaminated(docs, table.where("false")).collect() == []
    assert D.clean(docs, table.where("false")).count() == docs.count()
