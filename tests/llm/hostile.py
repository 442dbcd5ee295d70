"""Rows that no operator may stumble over: nulls, empty and very long texts, repeats, and columns with names used inside."""

import random

CLASHING = ("fp", "grade", "key", "bucket", "node", "n", "size", "path", "rank", "label", "body", "group", "part", "kind")


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(spark, texts, sources=None):
    """doc_id counts from 0; every clashing column is there too."""
    rows = [(i, t, "en", (sources[i] if sources else f"s{i % 3}"), len(t or ""), *range(len(CLASHING))) for i, t in enumerate(texts)]
    extra = ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")


def hostile_texts():
    rng = random.Random(5)
    one = prose(rng, 60)
    return [None, "", "   \t\n", "a", one, one, one, prose(rng, 60), prose(rng, 20_000), "é " * 40, "\x00\x1c x", "w1 " * 500]


def empty(docs):
    return docs.where("false")
