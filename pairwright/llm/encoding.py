"""Token ids of many texts at once, by the tokenizers library, each different piece of text encoded once.

A byte-level BPE with the usual pattern never joins a character that is no white space to white space behind it, so a
text may be cut there (other tokenizers get whole texts). Texts are cut at single spaces, the words of a batch are made distinct by Arrow, and only words
that the process has not met are given to the library; the ids are then gathered by their positions. Where a batch has many words, Arrow looks them up
too, which costs as much as the words held, and the new ones are given joined by spaces, thousands at once; else they go one by one.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED = 450_000
#: Different words of a batch from which on Arrow looks them up, words held for it, and words given to the library at once.
MANY = 100_000
WORDS = 800_000
JOINED = 4096

#: The White_Space property of Unicode, as the pattern of the tokenizer reads it.
_SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_CHUNK = re.compile(rf"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in _SPACE) + "]"
_ODD = f"{_CLASS} "
_EDGE = rf"\A{_CLASS}|{_CLASS}\z|\A\z"

_encoders: dict[str, BatchEncoder] = {}


def _letters() -> dict[int, str]:
    """The printable stand-in of each byte in vocabularies of this kind: itself where it is printable, else from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + n) for n, b in enumerate(rest)}


def _may_be_cut(spec: dict) -> bool:
    """Whether this is a byte-level BPE with the usual pattern and nothing before it, so that texts may be cut at white space."""
    first, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        spec.get("normalizer") is None and first.get("type") == "ByteLevel" and not first.get("add_prefix_space") and first.get("use_regex", True)
        and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    )


def _gathered(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `flat` that begin there and have these sizes, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


class BatchEncoder:
    """One for each tokenizer file and process. It holds a bounded number of pieces, starting anew when full, and of words
    with their ids in one array; when that is full, the words stay that were met again since it last was."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = _may_be_cut(json.loads(self.tokenizer.to_str()))
        self._split = regex.compile(public_tokenizers.PATTERN).findall
        self._model = self.tokenizer.model.tokenize
        self._letters = _letters()
        self._known: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._words = pa.array([], pa.large_string())
        self._ids, self._sizes, self._again = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, bool)
        if self.cuts:
            self._bare = Tokenizer(self.tokenizer.model)  # added tokens and truncation left out
            self._bare.pre_tokenizer = self.tokenizer.pre_tokenizer
            entries = self._bare.get_vocab()
            self._opens = np.zeros(max(entries.values(), default=0) + 1, bool)
            self._opens[[k for entry, k in entries.items() if entry.startswith(self._letters[32])]] = True

    def _part(self, part: str) -> bytes:
        made = array("I", [t.id for t in self._model(part.encode().decode("latin-1").translate(self._letters))]).tobytes()
        self._parts[part] = made
        return made

    def piece(self, piece: str) -> bytes:
        """The ids of a piece that starts and ends where a text may be cut, four bytes each."""
        of = self._parts
        known = of.get(piece) or self._known.get(piece)
        if known is None:
            if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
                return self._part(piece)
            if any(s in piece for s in self.special):
                return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
            known = b"".join([of.get(p) or self._part(p) for p in self._split(piece)])
            self._known[piece] = known
        return known

    def _made(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, their numbers) of a space and each word. The words neither start nor end with white
        space, so that they may be joined, and have no space, so that each has one id with a space: its first."""
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.scalar(" ", pa.large_string()))[0].as_py()
        ids = np.array(self._bare.encode_batch_fast([f" {text}"], add_special_tokens=False)[0].ids, "<u4")
        starts = np.flatnonzero(self._opens[ids])
        if len(starts) != len(words):  # the vocabulary has no space
            return self._singly(words)
        return ids, np.diff(np.append(starts, len(ids)))

    def _singly(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        entries = [self.piece(f" {w}") for w in words.to_pylist()]
        return np.frombuffer(b"".join(entries), "<u4"), np.fromiter(map(len, entries), np.int64, len(entries)) // 4

    def _found(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of a space and each of these different words begin among them, their numbers)."""
        if len(words) < MANY:
            ids, sizes = self._singly(words)
            return ids, np.cumsum(sizes) - sizes, sizes
        at = pc.index_in(words, value_set=self._words).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        self._again[at[at >= 0]] = True
        if len(new):
            edge = pc.match_substring_regex(words.take(pa.array(new)), _EDGE).to_numpy(zero_copy_only=False)
            new, n = np.concatenate([new[~edge], new[edge]]), int((~edge).sum())
            at[new] = np.arange(len(self._words), len(self._words) + len(new))
            taken = words.take(pa.array(new))
            made = [self._made(taken.slice(k, min(JOINED, n - k))) for k in range(0, n, JOINED)] + [self._singly(taken.slice(n))]
            self._words = pa.concat_arrays([self._words, taken])
            self._ids, self._sizes, self._again = (np.concatenate([x, *more]) for x, more in zip(
                (self._ids, self._sizes, self._again), [*zip(*made, strict=True), [np.zeros(len(new), bool)]], strict=True))
        ids, sizes = self._ids, self._sizes
        begin = np.cumsum(sizes) - sizes
        if len(sizes) > WORDS or len(ids) > 8 * WORDS:
            kept = np.flatnonzero(self._again)
            if len(kept) > WORDS // 2 or sizes[kept].sum() > 4 * WORDS:
                kept = kept[:0]
            self._words = self._words.take(pa.array(kept))
            self._ids, self._sizes, self._again = _gathered(ids, begin[kept], sizes[kept]), sizes[kept], np.zeros(len(kept), bool)
        return ids, begin[at], sizes[at]

    def _cut(self, text: str) -> list[str]:
        return [text] if any(s in text for s in self.special) else _CHUNK.findall(text)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text). Null texts are empty."""
        if not self.cuts:
            given = [t or "" for t in texts.to_pylist()]
            made = [e.ids for e in self.tokenizer.encode_batch(given, add_special_tokens=False)]
            return np.array([x for ids in made for x in ids], "<u4"), np.array([len(ids) for ids in made], np.int64)
        if len(self._known) > CACHED or len(self._parts) > CACHED:
            self._known.clear()
            self._parts.clear()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _ODD)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        plain = ~odd.to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts.filter(pa.array(plain)), " ")
        words = lists.flatten()
        offsets = lists.offsets.to_numpy()
        heads = words.take(pa.array(offsets[:-1])).to_pylist()
        words = words.dictionary_encode()
        ids, begin, sizes = self._found(words.dictionary)
        codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes[offsets[:-1]] = np.arange(len(begin), len(begin) + len(heads))
        entries = [self.piece(h) if h else b"" for h in heads]
        n_codes = np.empty(len(texts), np.int64)
        n_codes[plain] = np.diff(offsets)
        parts: list[np.ndarray] = []
        at, before = 0, np.cumsum(plain)
        for row in np.flatnonzero(~plain).tolist():
            pieces = self._cut(texts[row].as_py())
            stop = offsets[before[row]]
            parts.append(codes[at:stop])
            parts.append(np.arange(len(begin) + len(entries), len(begin) + len(entries) + len(pieces)))
            entries.extend(self.piece(p) for p in pieces)
            n_codes[row] = len(pieces)
            at = stop
        if parts:
            codes = np.concatenate([*parts, codes[at:]])
        more = np.fromiter(map(len, entries), np.int64, len(entries)) // 4
        begin = np.concatenate([begin, len(ids) + np.cumsum(more) - more])
        flat = np.concatenate([ids, np.frombuffer(b"".join(entries), "<u4")])
        lengths = np.concatenate([sizes, more])[codes]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.cumsum(n_codes)
        return _gathered(flat, begin[codes], lengths), bounds[ends] - bounds[ends - n_codes]


def encoder(path: str) -> BatchEncoder:
    if path not in _encoders:
        _encoders[path] = BatchEncoder(path)
    return _encoders[path]
