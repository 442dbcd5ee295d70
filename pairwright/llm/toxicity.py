"""Toxicity by cumulative-link ordinal regression over sparse text features.

Grades are ordered: 0 clean, 1 toxic, 2 toxic in a text of low quality. One weight for each feature is shared by all
thresholds: `P(grade > k) = sigmoid(score - threshold_k)`, thresholds in order. The output is the expected grade.

Features are hashed words and hashed beginnings of words, as shares of the words of the text; a score is a sum over words,
so a word has one weight wherever it stands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import pieces, plain, rows_where

#: Documents that the fit reads at most: the labelled ones with the smallest hash of their id.
SAMPLE = 5_000
BUCKETS = 1 << 18
BEGINNINGS = (3, 4, 5, 6, 7)
#: Words added to the length of a text, so that a single word in a short text does not weigh like many in a long one.
PADDING = 30.0
CACHED = 400_000
_NONWORD = r"[^\p{L}\p{N}]+"


def features_of(word: str) -> list[int]:
    """Buckets of the word and of its beginnings."""
    coded = [f"={word}", *[f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n]]
    return [zlib.crc32(c.encode("utf-8", "surrogatepass")) % BUCKETS for c in coded]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the lower-case words of all texts, offsets of each text). Words are runs of letters and digits, perhaps empty at the ends."""
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.split_pattern_regex(lower, _NONWORD)
    return lists.flatten(), lists.offsets.to_numpy()


@dataclass
class Ordinal:
    """weights by bucket, thresholds in order, and the expected grade from which a text is rejected."""

    weights: np.ndarray
    thresholds: np.ndarray
    reject: float

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))

    def severity(self, score: np.ndarray) -> np.ndarray:
        return self.above(score).sum(axis=1)


def fit(lengths: np.ndarray, buckets: np.ndarray, values: np.ndarray, grades: np.ndarray, top: int, learn: np.ndarray | None = None,
        steps: int = 150, ridge: float = 1e-7, rate: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps with momentum on the rows to learn from, in a fixed order, so that reruns agree.

    The entries of row k are the next `lengths[k]`, at least one, of `buckets` and `values`. Thresholds are the first and
    sums of positive steps.
    """
    n = len(grades)
    learn = np.ones(n, bool) if learn is None else learn
    share = learn / learn.sum()
    starts = np.cumsum(lengths) - lengths
    w = np.zeros(BUCKETS)
    counts = np.array([max(float(share @ (grades > k)), 1e-3) for k in range(top)])
    first = np.log((1 - counts) / counts)
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    m, v = np.zeros(len(w) + top), np.zeros(len(w) + top)
    at = np.arange(n)
    for step in range(1, steps + 1):
        thresholds = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        score = np.add.reduceat(w.astype(np.float32)[buckets] * values, starts, dtype=np.float64)
        upper = np.concatenate([np.ones((n, 1)), Ordinal(w, thresholds, 0).above(score), np.zeros((n, 1))], axis=1)
        p = np.maximum(upper[at, grades] - upper[at, grades + 1], 1e-9)
        slope = upper * (1 - upper)
        left, right = share * slope[at, grades] / p, share * slope[at, grades + 1] / p  # of the log-likelihood, by the score at either side
        by_score = (right - left).astype(np.float32)
        g_w = np.bincount(buckets, np.repeat(by_score, lengths) * values, len(w)) + ridge * w
        g_t = np.array([(left * (grades == k + 1) - right * (grades == k)).sum() for k in range(top)])
        g_free = np.concatenate([[g_t.sum()], [g_t[k:].sum() * np.exp(free[k]) for k in range(1, top)]])
        g = np.concatenate([g_w, g_free])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, free = w - move[:len(w)], free - move[len(w):] * 0.2
    return w.astype(np.float32), np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])


def best_reject(severity: np.ndarray, grades: np.ndarray) -> float:
    """The middle of the gap at which rejecting from there gives the best F1 of grades above zero."""
    order = np.argsort(-severity, kind="stable")
    hit = np.cumsum(grades[order] > 0)
    f1 = 2 * hit / (np.arange(1, len(order) + 1) + max((grades > 0).sum(), 1))
    ranked = severity[order]
    f1[:-1][ranked[:-1] == ranked[1:]] = -1
    k = int(np.argmax(f1))
    below = ranked[k + 1] if k + 1 < len(ranked) else 0.0
    return float((ranked[k] + below) / 2)


_SPARSE = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("buckets", pa.binary()), ("values", pa.binary())])


def _sparse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, 256):
        out = []
        words, offsets = split_words(batch.column(2))
        for k in range(batch.num_rows):
            counts: dict[int, float] = {}
            own = [w for w in words.slice(offsets[k], offsets[k + 1] - offsets[k]).to_pylist() if w]
            for word in own:
                for b in features_of(word):
                    counts[b] = counts.get(b, 0) + 1
            b = np.array(sorted(counts), "<i4")
            v = np.array([counts[x] for x in b.tolist()], "<f4") / (len(own) + PADDING)
            out.append((batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), b.tobytes(), v.astype("<f4").tobytes()))
        yield pa.RecordBatch.from_pylist([dict(zip(_SPARSE.names, x, strict=True)) for x in out], schema=_SPARSE)


def grades_of(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the rows of labels whose `toxic` is not null; a null quality is not low."""
    low = F.coalesce(F.col("quality") == 0, F.lit(False))
    grade = F.when(F.col("toxic") > 0, F.when(low, 2).otherwise(1)).otherwise(0).cast("int")
    return labels.where("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), grade.alias("grade"))


def train(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, id: str = "doc_id", text: str = "text") -> Ordinal:
    """Fits on at most `sample` labelled documents; a fifth of them sets the point of rejection. Reruns agree.

    Only this bounded sample comes to the driver, as hashed counts. Without a labelled document above grade zero nothing
    is rejected.
    """
    picked = grades.groupBy("doc_id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    read = docs.select(plain(id).cast("long").alias("doc_id"), plain(text).alias("text"))
    labelled = read.join(F.broadcast(picked), "doc_id").select("doc_id", "grade", "text")  # at most `sample` narrow rows
    found = labelled.mapInArrow(_sparse, "doc_id bigint, grade int, buckets binary, values binary").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["buckets"], r["values"]))
    found = [r for r in found if len(r["buckets"])]
    grade = np.array([r["grade"] for r in found], np.int64)
    top = int(grade.max()) if len(grade) else 0
    if top < 1:
        return Ordinal(np.zeros(BUCKETS, np.float32), np.array([60.0]), np.inf)
    lengths = np.array([len(r["buckets"]) // 4 for r in found])
    buckets = np.frombuffer(b"".join([r["buckets"] for r in found]), "<i4").astype(np.intp)
    values = np.frombuffer(b"".join([r["values"] for r in found]), "<f4")
    del found
    held = np.arange(len(grade)) % 5 == 4
    if not (grade[held] > 0).any() or not (grade[~held] > 0).any():
        held[:] = False
    weights, thresholds = fit(lengths, buckets, values, grade, top, ~held)
    model = Ordinal(weights, thresholds, np.inf)
    scores = np.add.reduceat(weights[buckets] * values, np.cumsum(lengths) - lengths, dtype=np.float64)
    test = held if held.any() else ~held
    model.reject = best_reject(model.severity(scores[test]), grade[test])
    return model


class Scorer:
    """Severities of batches of texts by one model; weights of words that were met are kept, up to a bound."""

    def __init__(self, model: Ordinal):
        self.model = model
        self.known: dict[str, float] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(severity, whether the text is rejected)."""
        words, offsets = split_words(texts)
        coded = words.dictionary_encode()
        entries = coded.dictionary.to_pylist()
        if len(self.known) > CACHED:
            self.known.clear()
        known, weights = self.known, self.model.weights
        of, real = np.zeros(len(entries)), np.ones(len(entries), bool)
        for k, word in enumerate(entries):
            if word:
                got = known.get(word)
                if got is None:
                    got = known[word] = float(weights[features_of(word)].sum())
                of[k] = got
            else:
                real[k] = False
        codes = coded.indices.to_numpy(zero_copy_only=False)
        total, count = (np.concatenate([[0.0], np.cumsum(x[codes])]) for x in (of, real))
        n = count[offsets[1:]] - count[offsets[:-1]]
        raw = (total[offsets[1:]] - total[offsets[:-1]]) / (n + PADDING)
        severity = np.where(n > 0, self.model.severity(raw), 0.0)
        return severity, (severity >= self.model.reject) & (n > 0)


def score(docs: DataFrame, model: Ordinal, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, severity (expected grade), toxic (whether it is rejected), for every row. No shuffle.

    Null and empty texts have severity zero and are never rejected; very long texts are read whole; repeated rows each
    get a row; an empty table gives an empty table; further columns are ignored. The model has a fixed size, whatever it
    was fitted on.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in pieces(batches, 1024):
            severity, toxic = scorer(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(severity), pa.array(toxic)], names=["doc_id", "severity", "toxic"])

    read = docs.select(plain(id).alias("doc_id"), plain(text).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(run, f"doc_id {kind}, severity double, toxic boolean")


def clean(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """The rows of `docs` whose text is not rejected, all columns as they are. No shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def masks(texts: Iterable[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(held.value)
        return (pa.array(~scorer(t)[1]) for t in texts)

    return rows_where(docs, text, masks)
