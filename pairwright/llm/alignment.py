"""Which tokens of two tokenizers cover the same bytes, and how often each pair of ids is linked in the whole corpus.

Texts are encoded by both; byte offsets where tokens of both end cut them into groups, and two tokens are linked where
their byte ranges overlap. Counting the links of a corpus is external:

1. A task turns its documents into records (pair, document, times), sorts them by pair and spills them as a run: the
   records stay with the run as zstandard columns, and its distinct pairs with their totals, dealt by radix of the B id,
   are its headers.
2. The headers of a radix from all runs are merged by a k-way heap, at most FAN at once, in rounds until one is left.
   Pairs come in order of their B id, so its highest count is known when its last pair has passed.
3. Counts stream back: every header is read beside the merged pairs of its radix, and the answers go to the run, whose
   records then give the sums of its documents.

A header has one entry for each different pair of a run, so neither a pair nor a B id that a third of all links hold makes a
hot group: it has one entry (one for each A id) in each run. Records are moved once, compressed, by run.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from pairwright.llm.common import cut, plain
from pairwright.llm.encoding import BatchEncoder

#: Links of a run, headers merged at once, merged pairs written in one row, bytes of text worked on at once.
RUN = 1 << 22
FAN = 64
CHUNK = 1 << 16
TEXT_BYTES = 1 << 20
#: Different words kept by the encoder of pieces.
CACHED = 200_000
_MIX = 0x9E3779B1  # odd, so that it permutes the ids
_ROWS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


class PlainEncoder(BatchEncoder):
    """Strings of special tokens are text like any other."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special = []
        self.tokenizer.encode_special_tokens = True

    def entries(self) -> list[bytes]:
        """The bytes of each id."""
        back = {c: b for b, c in self._letters.items()}
        vocabulary = self.tokenizer.get_vocab()
        out = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            out[k] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        return out


class PieceEncoder:
    """Ids of a sentencepiece model. Where no piece joins a space to what is before it, and texts are not changed first,
    words are encoded one by one and each different one once; other texts as a whole."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(self.model.serialized_model_proto())
        self.pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        same = spec.normalizer_spec
        self.cuts = (spec.trainer_spec.model_type == 2 and not same.precompiled_charsmap and same.add_dummy_prefix and same.escape_whitespaces
                     and not same.remove_extra_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
                     and not any("▁" in p.lstrip("▁") or p.startswith("▁▁") and p.strip("▁") for p in self.pieces))
        self._known: dict[str, bytes] = {}

    def entries(self) -> list[bytes]:
        is_byte = self.model.is_byte
        return [bytes([int(p[3:5], 16)]) if is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(self.pieces)]

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)] if texts else []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text); no text is null or empty."""
        odd = np.ones(len(texts), bool)
        if self.cuts:
            found = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, "▁"))
            odd = pc.or_(found, pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        words = lists.flatten().dictionary_encode()
        n_codes = np.ones(len(texts), np.int64)
        n_codes[~odd] = lists.value_lengths().to_numpy(zero_copy_only=False)
        given = words.dictionary.to_pylist()
        known = self._known
        if len(known) > CACHED:
            known.clear()
        new = [w for w in given if w not in known]
        known.update(zip(new, self._encoded(new), strict=True))
        entries = [known[w] for w in given] + self._encoded(texts.filter(pa.array(odd)).to_pylist())
        codes = np.empty(int(n_codes.sum()), np.int64)
        slots = np.repeat(~odd, n_codes)
        codes[slots] = words.indices.to_numpy(zero_copy_only=False)
        codes[~slots] = len(given) + np.arange(int(odd.sum()))
        sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        ids, _ = gathered(np.frombuffer(b"".join(entries), "<u4"), sizes, codes)
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(n_codes)])])


_encoders: dict[tuple[str, str], tuple[PlainEncoder, PieceEncoder, tuple, tuple]] = {}


def _both(a: str, b: str) -> tuple[PlainEncoder, PieceEncoder, tuple, tuple]:
    """Both encoders of a process, each with the bytes of its ids and their numbers."""
    if (a, b) not in _encoders:
        made = PlainEncoder(a), PieceEncoder(b)
        tables = [(np.frombuffer(b"".join(x), np.uint8), np.fromiter(map(len, x), np.int64, len(x))) for x in (e.entries() for e in made)]
        _encoders[a, b] = (*made, *tables)
    return _encoders[a, b]


def gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of `codes` one after another, and where each ends. `flat` has all entries, `sizes` long each."""
    begin, lengths = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(lengths)
    return flat[np.repeat(begin[codes] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


@dataclass(frozen=True)
class Aligned:
    """A batch of texts: for each, its numbers of tokens, groups and links, the text of its groups, and all its links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each number below n as right-aligned decimal digits with one place behind, and which places count."""
    wide = len(str(max(n - 1, 0)))
    text = np.char.rjust(np.arange(n).astype(str), wide).astype(f"S{wide}")
    table = np.zeros((n, wide + 1), np.uint8)
    table[:, :wide] = np.frombuffer(text.tobytes(), np.uint8).reshape(n, wide)
    used = table != 32
    return table, used


_DIGITS: list[tuple[np.ndarray, np.ndarray]] = []


def _group_texts(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, doc_of_group: np.ndarray, n_docs: int) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each document: ids in order, both sides of a group, groups apart."""
    most = int(max(a.max(initial=0), b.max(initial=0))) + 1
    if not _DIGITS or len(_DIGITS[0][0]) < most:
        _DIGITS[:] = [_digits(max(most, 1 << 16))]
    table, used = _DIGITS[0]
    n_groups = len(doc_of_group)
    upto_a, upto_b = np.searchsorted(group_a, np.arange(n_groups), "right"), np.searchsorted(group_b, np.arange(n_groups), "right")
    at_a = np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]
    at_b = np.arange(len(b)) + upto_a[group_b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[at_a], ids[at_b] = a, b
    rows, keep = table[ids], used[ids]
    rows[:, -1] = ord(",")
    rows[at_a[upto_a - 1], -1] = ord("|")
    rows[at_b[upto_b - 1], -1] = ord(";")
    flat = rows[keep].tobytes()
    ends = np.cumsum(keep.sum(axis=1))[at_b[upto_b - 1]] if n_groups else np.empty(0, np.int64)
    last = np.searchsorted(doc_of_group, np.arange(n_docs), "right") - 1
    out, at = [], 0
    for k, has in zip(last.tolist(), (np.bincount(doc_of_group, minlength=n_docs) > 0).tolist(), strict=True):
        end = int(ends[k]) if has else at
        out.append(flat[at:end - 1] if has else b"")
        at = end
    return out


def align_texts(texts: pa.Array, a_path: str, b_path: str) -> Aligned:
    """Texts that are null or empty, or whose tokens of either side do not spell a space and the text, have no tokens."""
    one, two, a_table, b_table = _both(a_path, b_path)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    whole = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    for checked in (False, True):
        given = texts.take(pa.array(whole))
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), given, pa.scalar("", pa.large_string()))
        a, n_a = one.encode(spaced)
        b, n_b = two.encode(given)
        length = pc.binary_length(spaced).to_numpy(zero_copy_only=False).astype(np.int64)
        bytes_a, end_a = gathered(*a_table, a)
        bytes_b, end_b = gathered(*b_table, b)
        want = np.frombuffer(b"".join(x.as_buffer() for x in spaced), np.uint8)
        if checked or len(want) == len(bytes_a) == len(bytes_b) and np.array_equal(want, bytes_a) and np.array_equal(want, bytes_b):
            break
        whole = whole[_spelled(want, length, (bytes_a, end_a, n_a), (bytes_b, end_b, n_b))]
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    text_ends = np.cumsum(length)
    doc_of = lambda ends: np.searchsorted(text_ends, ends, "left")
    group_doc = doc_of(cuts)
    each = np.union1d(end_a, end_b)  # every stretch between two ends belongs to one token of each side: a link
    full = lambda counts: np.bincount(whole, weights=counts, minlength=n).astype(np.int64)
    made = _group_texts(a, b, np.searchsorted(cuts, end_a, "left"), np.searchsorted(cuts, end_b, "left"), group_doc, len(whole))
    groups = [b""] * n
    for k, text in zip(whole.tolist(), made, strict=True):
        groups[k] = text
    n_groups = np.bincount(group_doc, minlength=len(whole))
    return Aligned(full(n_a), full(n_b), full(n_groups), full(n_a + n_b - n_groups), groups,
                   whole[doc_of(each)], a[np.searchsorted(end_a, each, "left")], b[np.searchsorted(end_b, each, "left")])


def _spelled(want: np.ndarray, length: np.ndarray, *sides: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which texts both sides spell."""
    good = np.ones(len(length), bool)
    ends = np.cumsum(length)
    for found, token_ends, counts in sides:
        upto = np.concatenate([[0], token_ends])[np.concatenate([[0], np.cumsum(counts)])]
        for k in range(len(length)):
            good[k] &= np.array_equal(found[upto[k]:upto[k + 1]], want[ends[k] - length[k]:ends[k]])
    return good


def _bounded(batches: Iterable[pa.RecordBatch], limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many bytes in their last column, or of one row."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, "right")))
            yield batch.slice(start, end - start)
            start = end


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers in as many bytes as the largest needs, compressed."""
    kind = np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}")


@dataclass(frozen=True)
class Keys:
    """How a pair and a document's number in its run share 64 bits: B id (permuted), A id, document."""

    a_bits: int
    b_bits: int
    radixes: int

    @property
    def doc_bits(self) -> int:
        return 64 - self.a_bits - self.b_bits

    def made(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray) -> np.ndarray:
        side = (b.astype(np.uint64) * np.uint64(_MIX)) & np.uint64((1 << self.b_bits) - 1)
        return ((side << np.uint64(self.a_bits) | a.astype(np.uint64)) << np.uint64(self.doc_bits)) | doc.astype(np.uint64)

    def sides(self, pairs: np.ndarray) -> np.ndarray:
        """The permuted B id."""
        return pairs >> np.uint64(self.a_bits)

    def radix(self, pairs: np.ndarray) -> np.ndarray:
        """Radixes are ranges of permuted B ids, so pairs in order are in order of radix."""
        return ((self.sides(pairs) * np.uint64(self.radixes)) >> np.uint64(self.b_bits)).astype(np.int64)

    def ids(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(A ids, B ids)."""
        back = pow(_MIX, -1, 1 << self.b_bits)
        b = (self.sides(pairs) * np.uint64(back)) & np.uint64((1 << self.b_bits) - 1)
        return (pairs & np.uint64((1 << self.a_bits) - 1)).astype(np.int64), b.astype(np.int64)


def keys_of(a_path: str, b_path: str, radixes: int) -> Keys:
    one, two, _, _ = _both(a_path, b_path)
    bits = lambda n: max(1, (n - 1).bit_length())
    return Keys(bits(len(one.entries())), bits(len(two.pieces)), radixes)


_SPILLED = ("run bigint, radix int, keys binary, totals binary, per_pair binary, docs binary, times binary, rows array<struct<"
            + ", ".join(f"{c.split()[0]}: {c.split()[1]}" for c in _ROWS.split(", ")) + ">>")
_ROW = pa.struct([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string())])
_SPILL = pa.schema([("run", pa.int64()), ("radix", pa.int32()), *((c, pa.binary()) for c in ("keys", "totals", "per_pair", "docs", "times")),
                    ("rows", pa.list_(_ROW))])


def _spill(a_path: str, b_path: str, keys: Keys):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        links: list[np.ndarray] = []
        rows: list[tuple] = []
        held = 0

        def spilled() -> pa.RecordBatch:
            flat = np.sort(np.concatenate(links)) if links else np.empty(0, np.uint64)
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.empty(0, np.int64)
            record, times = flat[first], np.diff(np.append(first, len(flat)))
            pair = record >> np.uint64(keys.doc_bits)
            doc = (record & np.uint64((1 << keys.doc_bits) - 1)).astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else first
            step = np.diff(doc, prepend=0)
            step[start] = doc[start]
            made, totals = pair[start], np.add.reduceat(times, start) if len(start) else times
            edges = np.searchsorted(keys.radix(made), np.arange(keys.radixes + 1))
            out = [{"run": number, "radix": -1, "per_pair": pack(np.diff(np.append(start, len(pair)))), "docs": pack(step), "times": pack(times),
                    "rows": [dict(zip(_ROW.names, r, strict=True)) for r in rows]}]
            out += [{"run": number, "radix": r, "keys": pack(made[s:e]), "totals": pack(totals[s:e])}
                    for r, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if e > s]
            return pa.RecordBatch.from_pylist(out, _SPILL)

        for batch in _bounded(batches):
            found = align_texts(batch.column(1), a_path, b_path)
            if rows and (held + len(found.a) > RUN or len(rows) + batch.num_rows > 1 << keys.doc_bits):
                yield spilled()
                number, links, rows, held = number + 1, [], [], 0
            links.append(keys.made(found.a, found.b, found.doc + len(rows)))
            held += len(found.a)
            digest = [hashlib.sha256(g).hexdigest() if g else "" for g in found.groups]
            rows += zip(batch.column(0).to_pylist(), *(x.tolist() for x in (found.n_a, found.n_b, found.n_groups, found.n_links)), digest, strict=True)
        if rows:
            yield spilled()

    return run


def _entries(keys: bytes, totals: bytes) -> Iterator[tuple[int, int]]:
    """(pair, total) of one header, in order."""
    pairs, counts = unpack(keys), unpack(totals)
    for s in range(0, len(pairs), 1024):
        yield from zip(pairs[s:s + 1024].tolist(), counts[s:s + 1024].tolist(), strict=True)


def _merge(keys: Keys):
    """Sorted by radix and pile: the headers of one are merged by a heap, and equal pairs added up. Rows end where a B id ends."""
    names = ["radix", "pile", "place", "keys", "totals", "best"]
    shift = keys.a_bits

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []

        def merged() -> Iterator[pa.RecordBatch]:
            pairs: list[int] = []
            counts: list[int] = []
            place = 0
            for pair, total in heapq.merge(*(_entries(*h) for h in held)):
                if pairs and pairs[-1] == pair:
                    counts[-1] += total
                    continue
                if len(pairs) >= CHUNK and pairs[-1] >> shift != pair >> shift:
                    yield row(pairs, counts, place)
                    pairs, counts, place = [], [], place + 1
                pairs.append(pair)
                counts.append(total)
            if pairs:
                yield row(pairs, counts, place)

        def row(pairs: list[int], counts: list[int], place: int) -> pa.RecordBatch:
            key, total = np.array(pairs, np.uint64), np.array(counts, np.int64)
            side = keys.sides(key)
            first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
            highest = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(side))))
            values = [*last, place, pack(key), pack(total), pack((total == highest).astype(np.uint8))]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            for radix, pile, *header in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (radix, pile) != last:
                    if held:
                        yield from merged()
                    last, held = (radix, pile), []
                held.append(header)
        if held:
            yield from merged()

    return run


_MERGED = "radix int, pile bigint, place bigint, keys binary, totals binary, best binary"


def _answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by radix, its merged pairs before its headers: the count of every pair of a header, and whether its B id has none higher."""
    last, held, pairs = None, [], np.empty(0, np.uint64)
    totals = best = np.empty(0, np.int64)
    for batch in batches:
        out: list[tuple] = []
        for radix, run, keys, total, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if radix != last:
                last, held, pairs = radix, [], None
            if run < 0:
                held.append((unpack(keys), unpack(total), unpack(top)))
                continue
            if pairs is None:
                pairs, totals, best = (np.concatenate(x) for x in zip(*held, strict=True))
                held = []
            at = np.searchsorted(pairs, unpack(keys))
            out.append((run, radix, pack(totals[at]), pack(best[at])))
        if out:
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["run", "radix", "totals", "best"])


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by run and radix, its records last: the sums of its documents."""
    counts: list[np.ndarray] = []
    tops: list[np.ndarray] = []
    for batch in batches:
        for _, _, total, top, per_pair, docs, times, rows in zip(*batch.columns, strict=True):
            if total.is_valid:
                counts.append(unpack(total.as_py()).astype(np.int64))
                tops.append(unpack(top.as_py()).astype(np.int64))
                continue
            per_pair, step, times = (unpack(x.as_py()).astype(np.int64) for x in (per_pair, docs, times))
            values = rows.values
            n_best, count_sum = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
            if len(per_pair):
                doc = np.cumsum(step)
                first = np.cumsum(per_pair) - per_pair
                doc -= np.repeat(np.concatenate([[0], doc])[first], per_pair)
                np.add.at(n_best, doc, times * np.repeat(np.concatenate(tops), per_pair))
                np.add.at(count_sum, doc, times * np.repeat(np.concatenate(counts), per_pair))
            counts, tops = [], []
            own = [values.field(k) for k in range(values.type.num_fields)]
            yield pa.RecordBatch.from_arrays([*own[:-1], pa.array(n_best), pa.array(count_sum), own[-1]],
                                             names=[*_ROW.names[:-1], "n_best", "count_sum", "groups_sha256"])


def spill(docs: DataFrame, a_path: str, b_path: str, keys: Keys, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The runs of a corpus, written: for each a row with its records and documents (radix -1), and one for each radix it has pairs of."""
    read = docs.select(plain(id).cast("long").alias("doc_id"), plain(text).cast("string").alias("text"))
    return cut(read.mapInArrow(_spill(a_path, b_path, keys), _SPILLED))


def merge_runs(spilled: DataFrame, keys: Keys) -> DataFrame:
    """(radix, place, keys, totals, best): all pairs of the corpus in order, at most FAN headers merged at once."""
    headers = spilled.where("radix >= 0").select("radix", "run", "keys", "totals")
    tasks = max(1, int(spilled.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    piles = -(-max(1, spilled.where("radix < 0").count()) // FAN)
    dealt = headers.withColumn("pile", F.pmod(F.xxhash64("run"), F.lit(piles)))
    while True:
        order = ("radix", "pile")
        sorted_ = dealt.select("radix", "pile", "keys", "totals").repartition(tasks, *order).sortWithinPartitions(*order)
        merged = cut(sorted_.mapInArrow(_merge(keys), _MERGED))
        if piles == 1:
            return merged.drop("pile")
        piles = -(-piles // FAN)
        dealt = merged.withColumn("pile", F.pmod("pile", F.lit(piles)))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, count, best): how often the corpus links each pair of ids, and whether no pair of its B id has more."""
    keys = keys_of(a_path, b_path, max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, total, top in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = keys.ids(unpack(key))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(unpack(total).astype(np.int64)), pa.array(unpack(top) > 0)],
                                                 names=["a", "b", "count", "best"])

    merged = merge_runs(spill(docs, a_path, b_path, keys, id, text), keys)
    return merged.select("keys", "totals", "best").mapInArrow(run, "a bigint, b bigint, count bigint, best boolean")


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and `groups`, the text of the aligned groups of each row. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _bounded(batches):
            found = align_texts(batch.column(1), a_path, b_path)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g.decode() for g in found.groups], pa.string())], names=["doc_id", "groups"])

    return docs.select(plain(id).cast("long").alias("doc_id"), plain(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, groups string")


def align(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    `n_best` counts the links whose pair has the highest count of its B id in the corpus, ties included; `count_sum` adds
    the counts of all links. Texts that are null or empty, or that one of the tokenizers does not spell byte by byte, have
    zeros and an empty digest and give no links. Repeated rows and ids count each; null ids stay null; a very long text is
    encoded as a whole, in a batch of its own. An empty table gives an empty table; further columns are ignored.
    """
    tasks = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = keys_of(a_path, b_path, tasks)
    spilled = spill(docs, a_path, b_path, keys, id, text)
    merged = merge_runs(spilled, keys)
    both = merged.select("radix", F.lit(-1).cast("long").alias("run"), "place", "keys", "totals", "best").union(
        spilled.where("radix >= 0").select("radix", "run", F.lit(0).cast("long"), "keys", F.lit(None).cast("binary"), F.lit(None).cast("binary")))
    met = both.repartition(tasks, "radix").sortWithinPartitions("radix", "run", "place").select("radix", "run", "keys", "totals", "best")
    answers = met.mapInArrow(_answer, "run bigint, radix int, totals binary, best binary")
    records = ("per_pair", "docs", "times", "rows")
    own = spilled.where("radix < 0").select("run", F.lit(1 << 30).alias("radix"), F.lit(None).cast("binary").alias("totals"),
                                            F.lit(None).cast("binary").alias("best"), *records)
    back = answers.select("run", "radix", "totals", "best", *[F.lit(None).cast(own.schema[c].dataType).alias(c) for c in records])
    home = back.union(own).repartition(tasks, "run").sortWithinPartitions("run", "radix")
    return home.mapInArrow(_sums, _ROWS.replace("groups_sha256", "n_best bigint, count_sum bigint, groups_sha256"))
