import hashlib
import random
import re

import pytest

from pairwright.llm import infill as I
from tests.llm.hostile import documents, empty, hostile_texts, prose


def plain_row(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, sha(text), sha(text))
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form = "spm" if h[3] % 100 < spm else "psm"
    made = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return (doc_id, len(units), form, len(p), len(m), sha(made), sha(text))


def lined(rng, n):
    return "".join(prose(rng, rng.randrange(1, 9)) + rng.choice(["\n", "\n\n", " é\n", "\r\n", " 𝄞 "]) for _ in range(n))


def cases():
    rng = random.Random(2)
    texts = hostile_texts() + ["\n", "\n\n\n", "a\n", "\na", "x <P> y", "<S>", "a<M", ">\n<", "<<P", "é\n" * 3000, "𝄞" * 70_000]
    return texts + [lined(rng, rng.randrange(1, 60)) for _ in range(60)] + [lined(rng, 9000), lined(rng, 3000).rstrip("\n")]


@pytest.mark.parametrize("frame", [64, 1 << 16])
def test_equals_plain_strings(spark, frame):
    texts = cases() if frame > 64 else [t for t in cases() if len(t or "") < 20_000]
    docs = documents(spark, texts)
    made = I.digests(I.infill(I.store_texts(docs, frame_bytes=frame), frame_bytes=frame)).collect()
    assert sorted(map(tuple, made)) == [plain_row(i, t) for i, t in enumerate(texts)]
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_rates_null_ids_repeats_and_empty(spark):
    rng = random.Random(4)
    rows = [(None, "a\nb"), (3, "a\nb"), (3, "a\nb"), (-5, lined(rng, 9))] + [(k, lined(rng, 5)) for k in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for rate, spm in ((100, 50), (40, 0), (0, 50), (100, 100)):
        made = sorted(map(tuple, I.infill_digests(docs, 7, rate, spm).collect()), key=repr)
        assert made == sorted((plain_row(i, t, 7, rate, spm) for i, t in rows), key=repr)
    assert I.infill_digests(empty(docs)).collect() == []


def test_the_output_is_there_as_text_and_few_frames_are_opened(spark):
    rng = random.Random(6)
    text = lined(rng, 4000)
    row = I.infill(I.store_texts(documents(spark, [text]), frame_bytes=1024), frame_bytes=1024).collect()[0]
    made = "".join(I.zstandard.ZstdDecompressor().decompress(bytes(f["data"])).decode() for f in row.output)
    assert hashlib.sha256(made.encode()).hexdigest() == plain_row(0, text)[5]
    kept = I.store([text.encode()], 1024)
    assert len(kept.data) > 50
    for n in (0, 1, 2000, kept.n_units - 1, kept.n_units):
        kept.opened = 0
        place = kept.after_units(n)
        assert kept.opened <= 1 and text.encode()[:place].decode() == "".join(re.findall(r"[^\n]*\n|[^\n]+", text)[:n])
        kept.opened = 0
        assert kept.chars_before(place) == len(text.encode()[:place].decode()) and kept.opened <= 1


def test_marks_across_frames():
    kept = I.store([b"ab<", b"P>", b"c" * 200 + b"<S", b"><M>"], 100)
    text = b"ab<P>" + b"c" * 200 + b"<S><M>"
    assert b"".join(kept.span(0, kept.bytes[-1])) == text
    for mark in (b"<P>", b"<S>", b"<M>", b"<X>"):
        assert kept.find(mark) == text.find(mark)
    assert kept.find(b"<P>", 3) == -1 and kept.find(b"<M>", 205) == 208
