"""Benchmark decontamination: rare n-gram seeds find test items in training texts, local alignment scores them.

The n-grams of an item are counted over all documents; of every few neighbouring n-grams of an item the rarest one is a
seed, so any stretch of an item has seeds, however often the item leaked. Where a text holds a seed, the words around it
are aligned to the item (Smith-Waterman over words), which finds edited and paraphrased copies.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import pieces, plain, rows_where

#: Words in a seed; neighbours of which the rarest is taken; n-grams of the items that one pass over the texts looks for.
WIDTH, NEIGHBOURS, BLOCK_GRAMS = 3, 4, 200_000
#: Alignment: a word that agrees, one that differs, one that is missing on either side.
MATCH, MISMATCH, GAP = 1, -1, -1
#: A stretch of an item with this score is a leak of it, however long the item is. Unrelated texts of the test tables reach 6.
STRETCH = 13
_CELLS = 1 << 20
_NONWORD = re.compile(r"[\W_]+")


def normal(text: str | None) -> str:
    """Lower-case runs of letters and digits, each with one space before and after."""
    return f" {_NONWORD.sub(' ', (text or '').lower()).strip()} "


def grams(words: list[str], width: int = WIDTH) -> list[str]:
    """Runs of `width` words; the whole where it has fewer; none without words."""
    if not words:
        return []
    n = max(1, len(words) - width + 1)
    return [f" {' '.join(words[k:k + width])} " for k in range(n)]


def seeds(of: list[str], frequency: Counter, neighbours: int = NEIGHBOURS) -> set[str]:
    """The rarest of each `neighbours` n-grams in a row that occur at all; of equal ones, the first in order of text."""
    windows = [[g for g in of[k:k + neighbours] if frequency[g]] for k in range(max(1, len(of) - neighbours + 1))]
    return {min(own, key=lambda g: (frequency[g], g)) for own in windows if own}


@dataclass
class Items:
    """A bounded block of test items with the patterns to look for."""

    words: dict[int, list[str]]
    patterns: dict[str, list[int]]  # pattern: places of its items in `ids`
    ids: list

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for pattern, items in self.patterns.items():
            made.add_word(pattern, (pattern, items))
        made.make_automaton()
        return made


def align(item: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The best local score of an item against each row of `windows` (-1: no word of the item)."""
    rows, width = windows.shape
    above = np.zeros((rows, width + 1), np.int32)
    best = np.zeros(rows, np.int32)
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    for word in item:
        now = np.zeros_like(above)
        now[:, 1:] = np.maximum(above[:, :-1] + np.where(windows == word, MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        np.maximum(best, now.max(axis=1), out=best)
        above = now
    return best


def _counter(held):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = held.value.automaton()
        total: Counter = Counter()
        for batch in pieces(batches, 256):
            for text in batch.column(0):
                total.update({p for _, (p, _) in found.iter(normal(text.as_py()))})
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["gram", "n"])

    return count


def _windows(text: str, hits: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """(start, end) of stretches of text around hits that lie near each other, cut at spaces."""
    start = last = hits[0]
    for at in [*hits[1:], None]:
        if at is not None and at - last <= reach:
            last = at
            continue
        low, high = max(0, start - reach), min(len(text), last + reach)
        low = text.rfind(" ", 0, low) if low else 0
        high = text.find(" ", high) if high < len(text) else len(text)
        yield max(low, 0), (high if high >= 0 else len(text))
        if at is not None:
            start = last = at


class Finder:
    """Looks for the items of a block in batches of texts."""

    def __init__(self, block: Items, threshold: float, least: int, stretch: int):
        self.block, self.threshold, self.least, self.stretch = block, threshold, least, stretch
        self.automaton = block.automaton()
        self.codes = {k: {w: c for c, w in enumerate(dict.fromkeys(own))} for k, own in block.words.items()}
        self.coded = {k: np.array([self.codes[k][w] for w in own], np.int32) for k, own in block.words.items()}
        self.reach = {k: 60 + int(1.5 * sum(len(w) + 1 for w in own)) for k, own in block.words.items()}

    def __call__(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(row, place of the item, best score) of what reaches the threshold, in order."""
        jobs: dict[int, list[tuple[int, list[str]]]] = defaultdict(list)
        for row, text in enumerate(map(normal, texts.to_pylist())):
            hits: dict[int, list[int]] = defaultdict(list)
            for end, (_, items) in self.automaton.iter(text):
                for k in items:
                    hits[k].append(end)
            for k, at in hits.items():
                jobs[k].extend((row, text[low:high].split()) for low, high in _windows(text, at, self.reach[k]))
        best: dict[tuple[int, int], int] = {}
        for k, todo in jobs.items():
            todo.sort(key=lambda j: len(j[1]))
            code, size = self.codes[k], len(self.coded[k])
            while todo:
                n = max(1, sum(1 for m, j in enumerate(todo, 1) if m * len(j[1]) <= _CELLS))
                part, todo = todo[:n], todo[n:]
                table = np.full((n, max(1, len(part[-1][1]))), -1, np.int32)
                for r, (_, words) in enumerate(part):
                    table[r, :len(words)] = [code.get(w, -1) for w in words]
                for (row, _), score in zip(part, align(self.coded[k], table).tolist(), strict=True):
                    if score >= self.stretch or score >= self.threshold * size and score >= min(self.least, size):
                        best[row, k] = max(score, best.get((row, k), 0))
        return [(row, k, score) for (row, k), score in sorted(best.items())]


def _blocks(docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, block_grams: int) -> Iterator[Items]:
    """The items in blocks of bounded size, with the seeds of each. The texts are read once for each, to count n-grams."""
    context = docs.sparkSession.sparkContext
    given = items.select(plain(item_id).cast("long").alias("item_id"), plain(item_text).alias("text"))
    size = given.select(F.coalesce(F.sum(F.greatest(F.lit(1), F.size(F.split("text", " ")))), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_grams))
    for b in range(blocks if size else 0):
        rows = given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).distinct().collect()
        rows = sorted((r for r in rows if normal(r["text"]).split()), key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if not rows:
            continue
        words = {k: normal(r["text"]).split() for k, r in enumerate(rows)}
        of = {k: grams(w) for k, w in words.items()}
        held = context.broadcast(Items({}, {g: [] for k in of for g in of[k]}, []))
        counted = docs.select(plain(text).alias("text")).mapInArrow(_counter(held), "gram string, n bigint")
        frequency = Counter({r["gram"]: r["n"] for r in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect()})  # n-grams of this block
        patterns: dict[str, list[int]] = defaultdict(list)
        for k, own in of.items():
            for g in seeds(own, frequency):
                patterns[g].append(k)
        if patterns:  # else no n-gram of the block is in any text
            yield Items(words, dict(patterns), [r["item_id"] for r in rows])


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, least: int = 6, stretch: int = STRETCH, id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text", block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """doc_id, item_id, words (score of the best alignment), score (its share of the item), where score >= threshold and words >= least, or
    words >= stretch: an excerpt of a long item, or an edited copy of it, is found by what is there.

    The items are the stated queries: they are read in blocks of about `block_grams` n-grams, by a hash, and
    each block is sent to all tasks and looked for in all texts, in two passes (counting, finding) without any shuffle
    of texts. Null and empty texts and items match nothing; an item of fewer than WIDTH words matches as a whole; very
    long texts are read whole; repeated rows of documents each give rows, repeated items give one; an item that a third
    of all texts hold costs one alignment in each. A null id of a document stays null, and so does that of an item.
    Empty tables give an empty table; further columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    read = docs.select(plain(id).alias("doc_id"), plain(text).alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()

    def finder(held):
        def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            look = Finder(held.value, threshold, least, stretch)
            for batch in pieces(batches, 256):
                found = look(batch.column(1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                    pa.array([look.block.ids[f[1]] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[2] / (MATCH * len(look.coded[f[1]])) for f in found], pa.float64()),
                ], names=["doc_id", "item_id", "words", "score"])

        return find

    parts = [
        read.mapInArrow(finder(context.broadcast(block)), f"doc_id {kind}, item_id bigint, words bigint, score double")
        for block in _blocks(docs, items, text, item_id, item_text, block_grams)
    ]
    none = read.where("false").select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("words", "long"), ("score", "double"))])
    return reduce(DataFrame.union, parts) if parts else none


def clean(docs: DataFrame, items: DataFrame, threshold: float = 0.5, least: int = 6, stretch: int = STRETCH, text: str = "text", item_id: str = "item_id",
          item_text: str = "text", block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """The rows of `docs` that hold no item by the rule of `contaminated`, all columns as they are. No shuffle.

    Null and empty texts stay; very long ones are read whole; repeated rows stay or go alike; items without an id are looked
    for too; null and empty items match nothing. Empty tables: none of documents gives none, none of items keeps all.
    No column is added, so none can clash.
    """
    out = docs
    for block in _blocks(docs, items, text, item_id, item_text, block_grams):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def masks(texts: Iterable[pa.Array], held=held) -> Iterator[pa.Array]:
            look = Finder(held.value, threshold, least, stretch)
            for part in texts:
                mask = np.ones(len(part), bool)
                mask[[f[0] for f in look(part)]] = False
                yield pa.array(mask)

        out = rows_where(out, text, masks)
    return out
