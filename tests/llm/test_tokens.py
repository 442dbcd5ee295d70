import io
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from pairwright.llm import encoding, tokens as T
from pairwright.llm.alignment import PlainEncoder
from pairwright.llm.common import shared_dir
from pairwright.llm.encoding import BatchEncoder
from tests.llm.hostile import documents, empty, hostile_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(texts):
    library = Tokenizer.from_file(PATH)
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_pieces_encode_as_the_whole(spark, sf_dir):
    rng = random.Random(7)
    letters = " \n\t\xa0\x1c\x85 \x0bab1!é'st<|endoftext|>  　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(2000)]
    texts += [None, "", "x <|endoftext|> y", "  a  b "] + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    made, counts = BatchEncoder(PATH).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(made, np.cumsum(counts)[:-1])] == ids_of(texts)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, texts = Tokenizer.from_file(path), ["Some  Words, more", None, "", "é x"]
    encoder = BatchEncoder(path)
    made, counts = encoder.encode(pa.array(texts))
    assert BatchEncoder(PATH).cuts and not encoder.cuts
    assert [x.tolist() for x in np.split(made, np.cumsum(counts)[:-1])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_new_words_of_a_large_batch_are_given_together():
    """Measured: word by word, Python around the library took most of a task."""
    encoder, calls = BatchEncoder(PATH), []
    model = encoder._model
    encoder._model = lambda part: calls.append(part) or model(part)
    texts = [" ".join(f"{chr(97 + k % 26)}{k:x},x" for k in range(n, n + 1000)) for n in range(0, 110_000, 1000)]
    made, counts = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(made, np.cumsum(counts)[:-1])] == ids_of(texts)
    assert len(calls) < 2000


@pytest.mark.parametrize(("words", "joined"), [(800_000, 4096), (40, 3), (0, 1)])
def test_large_batches_encode_as_the_whole(monkeypatch, words, joined):
    """Words that start or end with white space, special strings, and words held that are full again and again."""
    monkeypatch.setattr(encoding, "MANY", 0)
    monkeypatch.setattr(encoding, "WORDS", words)
    monkeypatch.setattr(encoding, "JOINED", joined)
    rng = random.Random(8)
    some = ["a", "\nb", "c\n", "\n", "\x85d\u2028", "é\xa0", "\x1ce", "<|endoftext|>", "f<|endoftext|>g", "", "'s", "12ab!?", "日本語", "😀", "Ġ", "h\r\n\r\n", "\t"]
    for encoder in (BatchEncoder(PATH), PlainEncoder(PATH)):
        for n in (0, 1, 7, 200, 200):
            texts = [" ".join(rng.choice(some) for _ in range(rng.randrange(8))) for _ in range(n)] + [None, "", " ", "a ", " a"] * min(n, 1)
            made, counts = encoder.encode(pa.array(texts, pa.string()))
            whole = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
            assert [made[e - c:e].tolist() for e, c in zip(np.cumsum(counts), counts, strict=True)] == whole
            assert len(encoder._sizes) <= max(words, 0) and len(encoder._words) == len(encoder._sizes) == len(encoder._again)


def test_a_vocabulary_without_a_space(tmp_path, monkeypatch):
    monkeypatch.setattr(encoding, "MANY", 0)
    spec = json.loads(Tokenizer.from_file(PATH).to_str())
    letters = {c: k for k, c in enumerate("abc")}
    spec["model"] |= {"vocab": letters, "merges": []}
    spec["added_tokens"], spec["post_processor"] = [], None
    (tmp_path / "few.json").write_text(json.dumps(spec))
    library, texts = Tokenizer.from_file(str(tmp_path / "few.json")), ["ab c a", "c b", "", "xa b"]
    made, counts = BatchEncoder(str(tmp_path / "few.json")).encode(pa.array(texts))
    assert [made[e - c:e].tolist() for e, c in zip(np.cumsum(counts), counts, strict=True)] == [library.encode(t).ids for t in texts]


@pytest.mark.parametrize("width", [2, 4])
def test_files_read_only_what_is_asked_for(width):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_000, n, dtype=np.uint32) for n in (0, 1, 5000, 3, 999, 12_000, 7)]
    out = io.BytesIO()
    writer = T.Writer(out, width, frame_tokens=1000)
    for k, ids in enumerate(docs):
        writer.add(None if k == 0 else k, ids)
    writer.close()
    reader = T.Reader(out)
    assert all((reader.document(k) == ids).all() for k, ids in enumerate(docs))
    fresh = T.Reader(out)
    (found,) = fresh.documents([4])
    assert found[0] == 4 and (found[1] == docs[4]).all() and fresh.read_frames == 2
    at, raw = 0, bytearray(out.getvalue())
    for size, plain, _ in fresh.frames:  # every frame stands alone
        assert len(zstandard.ZstdDecompressor().decompress(raw[at:at + size])) == plain
        at += size
    raw[fresh.at[1] + fresh.frames[1][0] // 2] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        T.Reader(io.BytesIO(raw)).document(2)


def test_round_trip_of_hostile_rows(spark):
    texts = hostile_texts()
    docs = documents(spark, texts)
    want, start = [], 0
    for i, ids in enumerate(ids_of(texts)):
        body = np.array([*ids, 2], "<u4")
        want.append((i, start, len(body), zlib.crc32(body.tobytes())))
        start += len(body)
    got = [tuple(r) for r in T.encode_documents(docs, PATH).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == want
    assert T.encode_documents(empty(docs), PATH).collect() == []
    twice = T.encode_documents(docs.union(docs), PATH).collect()
    assert len(twice) == 2 * len(texts) and len({r.start for r in twice}) == len(twice)
    folder = shared_dir(spark)
    manifest = T.write_tokens(docs, folder, PATH, parts=3)
    few = {r.doc_id: r.ids for r in T.read_documents(spark, manifest, folder, [4, 7]).collect()}
    assert few == {i: [*ids_of([texts[i]])[0], 2] for i in (4, 7)}
