import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pairwright.llm import alignment as A
from tests.llm.hostile import documents, empty, hostile_texts, prose

PATHS = (P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))


def letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


def plain_rows(texts):
    """Tokens, groups, links and counts one by one."""
    one = Tokenizer.from_file(PATHS[0])
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    back, entry = letters(), {k: t for t, k in one.get_vocab().items()}
    every, rows = Counter(), []
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in entry[k]) for k in a]
        bytes_b = [bytes([int(two.id_to_piece(k)[3:5], 16)]) if two.is_byte(k) else two.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            rows.append(([], [], [], []))
            continue
        spans = []
        for made in (bytes_a, bytes_b):
            at, out = 0, []
            for x in made:
                out.append((at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, start = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(t) for t, (s, e) in zip(ids, sp, strict=True) if start <= s and e <= c) for ids, sp in zip((a, b), spans, strict=True))
                          if len(text) < 3000 else "")
            start = c
        every.update(links)
        rows.append((a, b, groups, links))
    most = defaultdict(int)
    for (_, b), n in every.items():
        most[b] = max(most[b], n)
    return [
        (i, len(a), len(b), len(groups), len(links), sum(every[x] == most[x[1]] for x in links), sum(every[x] for x in links),
         "" if not a else hashlib.sha256(";".join(groups).encode()).hexdigest() if len(texts[i]) < 3000 else None)
        for i, (a, b, groups, links) in enumerate(rows)
    ], every


def cases():
    rng = random.Random(3)
    odd = ["  two  spaces ", " ", "\n", "a\nb\n\n c", "<|endoftext|> x", "a<|endoftext|>", "▁", "x ▁y", "tab\there", "日本語 の 文", "𝄞 é ü", "don't we'll  I'd",
           " nbsp", "1234567 12,345.67", "<0x0A>", "ﬁ ligature Å", "a" * 300, "\r\n mixed \r", "ＦＵＬＬ width", "\x00 \x01"]
    return hostile_texts() + odd + [prose(rng, rng.randrange(1, 80)) for _ in range(30)] + ["the cat sat on the mat"] * 5


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_alignment(spark, monkeypatch, small):
    if small:  # many runs, several rounds of merging, rows that end at a B id; the workers read these from the closure's module
        monkeypatch.setattr(A, "FAN", 2)
    texts = cases()
    docs = documents(spark, texts).repartition(7 if small else 2)
    want, _ = plain_rows(texts)
    for got, row in zip(sorted(A.align(docs, *PATHS).collect(), key=lambda r: r.doc_id), want, strict=True):
        assert tuple(got)[:7] == row[:7] and row[7] in (None, got.groups_sha256)


def test_counts_groups_repeats_and_empty(spark):
    texts = ["the cat sat", "the cat sat", "", None, "über\nthe cats"]
    docs = spark.createDataFrame([(None if k < 2 else 4, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want, every = plain_rows([t or "" for t in texts])
    got = [tuple(r) for r in A.align(docs, *PATHS).collect()]
    assert sorted(map(repr, got)) == sorted(repr((None if i < 2 else 4, *r[1:])) for i, r in enumerate(want))
    counts = {(r.a, r.b): r["count"] for r in A.pair_counts(docs, *PATHS).collect()}
    assert counts == dict(every)
    groups = sorted(r.groups for r in A.aligned_groups(docs, *PATHS).collect())
    assert sorted(hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups) == sorted(r[7] for r in want)
    assert A.align(empty(docs), *PATHS).collect() == []


def test_runs_are_cut_and_batches_bounded(monkeypatch):
    """In one process, so that the sizes hold."""
    import pyarrow as pa
    import pyspark

    class Task:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(pyspark.TaskContext, "get", classmethod(lambda cls: Task))
    monkeypatch.setattr(A, "RUN", 300)
    monkeypatch.setattr(A, "CHUNK", 8)
    texts = [t for t in cases() if len(t or "") < 3000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    monkeypatch.setattr(A._bounded, "__defaults__", (200,))
    assert [sum(len((t or "").encode()) for t in b.column(1).to_pylist()) <= 200 or b.num_rows == 1 for b in A._bounded([batch])].count(False) == 0
    keys = A.keys_of(*PATHS, 5)
    spilled = [b for b in A._spill(*PATHS, keys)([batch])]
    assert len(spilled) > 5 and len({b.column(0)[0].as_py() for b in spilled}) == len(spilled)
    heads = sorted((r["radix"], r["run"], r["keys"], r["totals"]) for b in spilled for r in b.to_pylist() if r["radix"] >= 0)
    given = pa.RecordBatch.from_arrays([pa.array([h[0] for h in heads], pa.int32()), pa.array([0] * len(heads), pa.int64()),
                                        pa.array([h[2] for h in heads]), pa.array([h[3] for h in heads])], names=["radix", "pile", "keys", "totals"])
    merged = [r for b in A._merge(keys)([given]) for r in b.to_pylist()]
    assert max(r["place"] for r in merged) > 0
    _, every = plain_rows([t or "" for t in texts])
    found = {}
    for r in merged:
        a, b = keys.ids(A.unpack(r["keys"]))
        found |= dict(zip(zip(a.tolist(), b.tolist(), strict=True), A.unpack(r["totals"]).tolist(), strict=True))
    assert found == dict(every)
