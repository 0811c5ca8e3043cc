"""Words of UTF-8 texts as 64-bit hashes, with numpy."""

from __future__ import annotations

import hashlib

import numpy as np

from tessera.llm.hashing import PolynomialHash, mix

#: Bytes hashed at once; a longer word is hashed whole by another function.
PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of every word: runs without ASCII white space."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = SPACE[raw]
    change = np.flatnonzero(space[1:] != space[:-1]) + 1
    first = [] if space[0] else [0]
    last = [] if space[-1] else [len(raw)]
    edges = np.concatenate([np.array(first, np.int64), change, np.array(last, np.int64)])
    return edges[::2], edges[1::2]


def word_hashes(texts: list[str | None], hasher: PolynomialHash) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, end to end, and the number of words of each text."""
    return encoded_word_hashes([(t or "").encode() for t in texts], hasher)


def encoded_word_hashes(encoded: list[bytes], hasher: PolynomialHash) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, of texts in UTF-8."""
    data = b" ".join(encoded)
    raw = np.frombuffer(data, np.uint8)
    starts, ends = word_bounds(raw)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = int(np.searchsorted(ends, a + PIECE, side="right"))
        if j <= i:
            out[i] = int.from_bytes(hashlib.blake2b(data[a:int(ends[i])], digest_size=8).digest(), "little")
            i += 1
            continue
        sums = hasher.prefix(raw[a:int(ends[j - 1])])
        out[i:j] = hasher.spans(sums, starts[i:j] - a, ends[i:j] - a)
        i = j
    border = np.cumsum([len(x) + 1 for x in encoded])
    return out, np.diff(np.searchsorted(starts, border), prepend=0)


def rolling(words: np.ndarray, n: int, hasher: PolynomialHash) -> np.ndarray:
    """Hash of every ``n`` consecutive words, by the first of them."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    hasher.grow(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * hasher.powers[:len(words)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * hasher.inverses[:len(words) - n + 1])
