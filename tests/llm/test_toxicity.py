import random

import numpy as np
import pyarrow as pa

from pairwright.llm import toxicity as T
from tests.llm.hostile import documents, empty, hostile_texts, prose

BAD = ["idioto", "stupido", "wortlos"]


def toxic(rng, n, dose):
    words = prose(rng, n).split()
    for _ in range(dose):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


def test_likelihood_gradient_points_down():
    """Fitting separates ordered grades, and thresholds stay in order."""
    rng = np.random.default_rng(1)
    grades = np.repeat([0, 1, 2], 40)
    buckets = np.stack([np.full(120, 7), rng.integers(100, 200, 120)], axis=1).ravel()
    values = np.stack([grades * 0.1 + 0.01, np.full(120, 0.05)], axis=1).ravel()
    weights, thresholds = T.fit(np.full(120, 2), buckets, values, grades, 2)
    assert thresholds[0] < thresholds[1]
    model = T.Ordinal(weights, thresholds, 0.5)
    severity = model.severity(weights[7] * (np.array([0, 1, 2]) * 0.1 + 0.01))
    assert severity[0] < 0.5 < severity[1] < 1.5 < severity[2]
    assert (np.diff(model.above(np.array([0.3])), axis=1) < 0).all()


def test_fit_equals_a_plain_fit_of_the_likelihood():
    """Three dense features, the likelihood written out, its gradient by differences, steps that only go down."""
    rng = np.random.default_rng(4)
    x = rng.uniform(0, 0.1, (300, 3)).astype("f4")
    grades = np.searchsorted([1.0, 2.5], x @ np.array([60.0, -30.0, 10.0]) + rng.logistic(size=300))

    def loss(p):
        edges = np.array([-1e3, p[3], p[3] + np.exp(p[4]), 1e3])
        below = 1 / (1 + np.exp(np.clip((x @ p[:3])[:, None] - edges[None, :], -500, 500)))
        at = np.arange(len(x))
        return -np.log(below[at, grades + 1] - below[at, grades]).mean()

    plain, step = np.zeros(5), np.full(5, 1.0)
    for _ in range(400):  # one coordinate at a time
        for c in range(5):
            tries = [plain + d * step[c] * np.eye(5)[c] for d in (-1, 0, 1)]
            best = int(np.argmin([loss(t) for t in tries]))
            plain, step[c] = tries[best], step[c] * (0.7 if best == 1 else 1.3)
        if step.max() < 1e-3:
            break
    weights, thresholds = T.fit(np.full(300, 3), np.tile([7, 8, 9], 300), x.ravel(), grades, 2)
    fitted = np.array([*weights[7:10], thresholds[0], np.log(thresholds[1] - thresholds[0])])
    assert abs(loss(fitted) - loss(plain)) < 0.01 and loss(fitted) < loss(np.zeros(5)) - 0.05
    assert np.corrcoef(x @ fitted[:3], x @ plain[:3])[0, 1] > 0.99


def test_held_out_accuracy_and_rejection(spark):
    rng = random.Random(11)
    bad = [k % 5 == 0 for k in range(800)]
    texts = [toxic(rng, 80, 4) if b else prose(rng, 80) for b in bad]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, k % 2, int(bad[k])) for k in range(500)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = T.train(docs, T.grades_of(labels))
    assert len(model.thresholds) == 2
    rest = {r.doc_id: r for r in T.score(docs, model).collect() if r.doc_id >= 500}
    assert np.mean([rest[k].toxic == bad[k] for k in rest]) > 0.97
    assert min(r.severity for k, r in rest.items() if bad[k]) >= 0 and max(r.severity for r in rest.values()) <= 2
    kept = T.clean(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in T.score(docs, model).where("not toxic").collect()}
    again = T.train(docs.repartition(5), T.grades_of(labels))
    assert np.array_equal(again.weights, model.weights) and again.reject == model.reject


def test_hostile_rows(spark):
    docs = documents(spark, hostile_texts())
    labels = spark.createDataFrame([(4, 1, 1), (7, 1, 0), (0, 0, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.score(docs, T.train(docs, T.grades_of(labels))).collect()}
    assert len(got) == docs.count() and all(got[k].severity == 0 and not got[k].toxic for k in (0, 1, 2))
    assert got[4].severity == got[5].severity == got[6].severity
    none = T.train(docs, T.grades_of(labels.where("false")))
    assert not any(r.toxic for r in T.score(docs, none).collect())
    assert T.score(empty(docs), none).collect() == [] and T.clean(docs, none).count() == docs.count()


def test_scores_are_sums_over_words():
    model = T.Ordinal(np.random.default_rng(2).normal(size=T.BUCKETS).astype(np.float32), np.array([0.0, 1.0]), 1.0)
    text = "Some, words. Some WORDS again—é"
    words = ["some", "words", "some", "words", "again", "é"]
    raw = sum(float(model.weights[T.features_of(w)].sum()) for w in words) / (len(words) + T.PADDING)
    severity, rejected = T.Scorer(model)(pa.array([text, None, ""]))
    assert np.isclose(severity[0], model.severity(np.array([raw]))[0]) and list(severity[1:]) == [0, 0] and not rejected[1:].any()
