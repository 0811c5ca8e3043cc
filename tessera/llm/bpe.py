"""Byte-level BPE by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never end up inside one
token of an encoding, so every such pair marks a certain cut. Together with the
boundaries of the pre-tokenizer, these cuts split a text into short fragments;
each fragment is encoded on its own and the ids are concatenated. Fragments
repeat heavily, so a worker keeps a bounded memo of fragment -> ids.

``encode`` and ``decode`` are column expressions (Arrow UDFs): row-wise, no
shuffle, nothing kept beyond one Arrow batch and the memo.

Defined results: null text counts as empty; an empty text gives an empty id
list; null ids decode to the empty text; the special token's literal in a text
becomes its one id. Other columns of the frame are never read.
"""

from __future__ import annotations

import functools
import json
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Long fragments whose ids a worker remembers (some 200 bytes each).
MEMO_FRAGMENTS = 1 << 16
GROUP_CHARS = 1 << 16

LETTER, NUMBER, SPACE, END = 1, 2, 3, 4


def tokenizer_file(path: str | None = None) -> str:
    """``path``, or the default public vocabulary file."""
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(DEFAULT_VOCABULARY)


def byte_symbols() -> list[str]:
    """The printable symbol that stands for each byte in a byte-level vocabulary."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(shifted)) for b in range(256)]


@functools.lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or 0 for the rest."""
    import regex
    table = np.zeros(0x110000, np.uint8)
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, points))
    at = np.array(points)
    for label, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            table[at[m.start():m.end()]] = label
    return table


class FragmentTable:
    """Ids of fragments of at most 15 bytes, looked up for a whole array at once.

    A fragment is its bytes in two 64-bit words, the length in the topmost byte:
    keys are the fragments themselves, so a hit is exact. One entry per slot;
    fragments whose slot is taken, and longer ones, go through a dictionary.
    """

    BITS = 20

    def __init__(self):
        size = 1 << self.BITS
        self.low, self.high = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.at, self.count = np.zeros(size, np.int64), np.zeros(size, np.int32)
        self.pool = np.empty(1 << 16, np.int32)
        self.used = 0

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        h = low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(31)
        return (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def add(self, slot: int, low: int, high: int, ids: list[int]) -> None:
        if self.count[slot]:
            return
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.low[slot], self.high[slot], self.at[slot], self.count[slot] = low, high, self.used, len(ids)
        self.used += len(ids)


LOW_MASK = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(16)], np.uint64)
HIGH_MASK = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(16)], np.uint64)


class Vocabulary:
    """A byte-level BPE file: token bytes, pairs inside tokens, fragment memo."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.symbols = byte_symbols()
        byte_of = {s: b for b, s in enumerate(self.symbols)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*spec["model"]["vocab"].values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        inside = np.zeros(1 << 16, bool)
        for token, i in spec["model"]["vocab"].items():
            if token in self.special:
                continue
            raw = bytes(byte_of[c] for c in token)
            self.token_bytes[i] = raw
            for a, b in pairwise(raw):
                inside[a << 8 | b] = True
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.certain_cut = ~inside
        self.model = Tokenizer.from_file(path).model
        self.table = FragmentTable()
        self.memo: dict[bytes, list[int]] = {}

    def _fragment(self, fragment: bytes) -> list[int]:
        ids = self.memo.get(fragment)
        if ids is None:
            symbols = self.symbols
            ids = [t.id for t in self.model.tokenize("".join([symbols[b] for b in fragment]))]
            if len(self.memo) >= MEMO_FRAGMENTS:
                self.memo.clear()
            self.memo[fragment] = ids
        return ids

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without special literals, end to end, and how many each has."""
        joined = "\0".join(texts) + "\0"
        ends = np.cumsum(np.array([len(t) + 1 for t in texts])) - 1
        data = joined.encode()
        cuts, last = fragment_starts(joined, data, ends, self.certain_cut)
        width = np.diff(cuts, append=len(data))
        words = np.ndarray((len(data) + 1,), "<u8", data + bytes(16), strides=(1,))
        short = np.minimum(width, 15)
        low = words[cuts] & LOW_MASK[short]
        high = words[np.minimum(cuts + 8, len(data))] & HIGH_MASK[short] | short.astype(np.uint64) << np.uint64(56)
        t = self.table
        slot = t.slots(low, high)
        known = (t.low[slot] == low) & (t.high[slot] == high) & (width <= 15)
        known[last] = True
        at, count = t.at[slot], t.count[slot]
        count[last] = 0
        extra: list[int] = []
        base = 0
        missing = np.flatnonzero(~known).tolist()
        if missing:
            found = []
            for k in missing:
                i, w = int(cuts[k]), int(width[k])
                ids = self._fragment(data[i:i + w])
                if w <= 15:
                    t.add(int(slot[k]), int(low[k]), int(high[k]), ids)
                found.append(len(ids))
                extra += ids
            base = t.used
            count[missing] = found
            at[missing] = base + np.cumsum([0, *found[:-1]])
        pool = np.concatenate([t.pool[:t.used], np.array(extra, np.int32)]) if extra else t.pool
        before = np.cumsum(count) - count
        flat = pool[np.repeat(at - before, count) + np.arange(int(count.sum()))]
        return flat, np.diff(before[last], prepend=0)

    def _with_special(self, text: str) -> np.ndarray:
        out: list[np.ndarray] = []
        pending: list[str | int] = [text]
        for literal, i in self.special.items():
            split: list[str | int] = []
            for part in pending:
                if isinstance(part, int) or literal not in part:
                    split.append(part)
                    continue
                for k, piece in enumerate(part.split(literal)):
                    split += [i, piece] if k else [piece]
            pending = split
        for part in pending:
            out.append(np.array([part], np.int32) if isinstance(part, int) else self._plain([part])[0])
        return np.concatenate(out)

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        flat, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        group: list[str] = []
        size = 0

        def flush():
            if group:
                ids, each = self._plain(group)
                flat.append(ids)
                counts.append(each)

        for text in texts:
            text = text or ""
            if any(x in text for x in self.special):
                flush()
                group, size = [], 0
                flat.append(self._with_special(text))
                counts.append(np.array([len(flat[-1])]))
                continue
            group.append(text)
            size += len(text)
            if size > GROUP_CHARS:
                flush()
                group, size = [], 0
        flush()
        return np.concatenate(flat), np.concatenate(counts)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def word_starts(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where the pre-tokenizer begins a piece.

    Pieces are runs of one class. One blank joins the run after it; the last
    white-space character before another run stands apart from those before it;
    a contraction ('s 't 're 've 'm 'll 'd) that begins a piece is a piece.
    """
    starts = np.empty(len(codes), bool)
    starts[0] = True
    np.not_equal(classes[1:], classes[:-1], out=starts[1:])
    after_space = np.flatnonzero((classes[:-1] == SPACE) & (classes[1:] != SPACE) & (classes[1:] != END)) + 1
    starts[after_space - 1] = True
    starts[after_space[codes[after_space - 1] == 0x20]] = False
    quotes = np.flatnonzero((codes[:-1] == 0x27) & starts[:-1])
    for q in quotes.tolist():
        tail = "".join(map(chr, codes[q + 1:q + 3]))
        width = 1 if tail[:1] in ("s", "t", "m", "d") else 2 if tail in ("re", "ve", "ll") else 0
        if width:
            starts[q + 1:q + 1 + width] = False
            starts[q + 1 + width] = True
    return starts


def fragment_starts(joined: str, data: bytes, ends: np.ndarray,
                    certain_cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which fragments begin, and which of them are end marks.

    ``joined`` holds texts with one mark after each, at the positions ``ends``;
    no piece reaches across a mark.
    """
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    raw = np.frombuffer(data, np.uint8)
    classes = character_classes()[codes]
    classes[ends] = END
    starts = word_starts(codes, classes)
    starts[ends] = True
    starts[ends[:-1] + 1] = True
    if len(codes) != len(raw):
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        spread = np.zeros(len(raw), bool)
        spread[lead[starts]] = True
        starts, ends = spread, lead[ends]
    pairs = raw[:-1].astype(np.uint16) << 8 | raw[1:]
    starts[1:] |= certain_cut[pairs]
    cuts = np.flatnonzero(starts)
    return cuts, np.searchsorted(cuts, ends)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One loaded vocabulary per worker process and file."""
    return Vocabulary(path)


def encode(text: Column, path: str | None = None) -> Column:
    """Ids of each whole text (``array<int>``), equal to the tokenizers library's
    with ``add_special_tokens=False``."""
    @F.arrow_udf("array<int>")
    def encode_texts(texts: pa.Array) -> pa.Array:
        v = vocabulary(tokenizer_file(path))
        flat, counts = v.encode_many(texts.to_pylist())
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), flat)
    return encode_texts(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Text of each id list, special tokens included."""
    @F.arrow_udf("string")
    def decode_ids(lists: pa.Array) -> pa.Array:
        v = vocabulary(tokenizer_file(path))
        lists = lists.fill_null([]) if lists.null_count else lists
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        return pa.array([v.decode(flat[a:b].tolist()) for a, b in pairwise([0, *ends.tolist()])], pa.string())
    return decode_ids(ids)


def round_trip(text: Column, path: str | None = None) -> Column:
    """``struct<ids, decoded>`` of each whole text: its ids and their decoding, in one pass of one operator."""
    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def encode_and_decode(texts: pa.Array) -> pa.Array:
        v = vocabulary(tokenizer_file(path))
        flat, counts = v.encode_many(texts.to_pylist())
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        decoded = pa.array([v.decode(flat[a:b].tolist()) for a, b in pairwise(ends.tolist())], pa.string())
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, flat), decoded], ["ids", "decoded"])
    return encode_and_decode(text)


def encode_checked(text: Column, path: str | None = None) -> Column:
    """``struct<ids, round_trip>``: ids of each whole text, and whether they decode to it (null: empty)."""
    @F.arrow_udf("struct<ids:array<int>,round_trip:boolean>")
    def encode_and_compare(texts: pa.Array) -> pa.Array:
        v = vocabulary(tokenizer_file(path))
        given = texts.to_pylist()
        flat, counts = v.encode_many(given)
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        same = [v.decode(flat[a:b].tolist()) == (t or "") for t, (a, b) in zip(given, pairwise(ends.tolist()))]
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, flat), pa.array(same, pa.bool_())], ["ids", "round_trip"])
    return encode_and_compare(text)
