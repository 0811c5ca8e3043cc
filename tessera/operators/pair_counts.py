"""What a batch of text pairs has in common, counted over the whole batch at once.

Texts are split at white space and each distinct word of a batch is cut into tokens once; tokens are
numbers from then on, and a batch is a few flat arrays. An n-gram occurs in a reference only if
both of its (n-1)-grams do, so an order looks only at the places that the order before it matched.
All counts are exact: grams get their numbers from sorted keys, never from hashes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TERM = re.compile("[a-z0-9]+")


def terms_of(word: str) -> list[str]:
    """Lower-case alphanumeric runs."""
    return [word.lower()] if word.isascii() and word.isalnum() else _TERM.findall(word.lower())


def stems(tokens: list[str]) -> list[str]:
    """Tokens of more than three letters by their stem."""
    from tessera.functions.porter import stem
    return [stem(t) if len(t) > 3 else t for t in tokens]


class _Numbers(dict):
    """Numbers in order of first sight."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first, first + 1, ..`` of every range, ``n`` long each, in a row."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


class Words:
    """The words of some texts as numbers."""

    def __init__(self, texts: pa.Array):
        split = pc.utf8_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        self.distinct = coded.dictionary.to_pylist()
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
        self.at = split.offsets.to_numpy().astype("int64")

    def tokens(self, cut: Callable[[str], list[str]], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Token numbers of the texts ``rows`` in a row, where each of these starts, with the end, and the distinct tokens."""
        cuts = list(map(cut, self.distinct))
        number, n = _Numbers(), np.fromiter(map(len, cuts), "int64", len(cuts))
        flat = np.fromiter(map(number.__getitem__, chain.from_iterable(cuts)), "int64", n.sum())
        size = self.at[rows + 1] - self.at[rows]
        code = self.code[_ranges(self.at[rows], size)]
        ends = np.concatenate(([0], np.cumsum(n[code])))
        return flat[_ranges((np.cumsum(n) - n)[code], n[code])], ends[np.concatenate(([0], np.cumsum(size)))], list(number)


def renumbered(tokens: np.ndarray, names: list[str]) -> np.ndarray:
    """Tokens under new names, equal numbers for equal names."""
    number = _Numbers()
    return np.fromiter(map(number.__getitem__, names), "int64", len(names))[tokens]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, "int64")
    return keys[first], np.diff(np.append(first, len(keys)))


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``, -1 for those not in it."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums by owner (in order), as integers."""
    total = np.concatenate(([0], np.cumsum(values, dtype="int64")))
    return np.diff(total[np.searchsorted(owner, np.arange(n + 1))])


class Pairs:
    """A batch: tokens of distinct references, tokens of predictions, and each prediction's reference."""

    def __init__(self, refs: tuple[np.ndarray, np.ndarray], preds: tuple[np.ndarray, np.ndarray], ref_of: np.ndarray):
        (self.ref, self.ref_at), (self.pred, self.pred_at), self.ref_of = refs, preds, ref_of
        self.n_refs, self.n = len(self.ref_at) - 1, len(ref_of)
        self.base = int(max(self.ref.max(initial=0), self.pred.max(initial=0))) + 1
        self.ref_no = np.repeat(np.arange(self.n_refs), np.diff(self.ref_at))
        self.pair_no = np.repeat(np.arange(self.n), np.diff(self.pred_at))
        self.keys, self.counts = _distinct(self.ref_no * self.base + self.ref)  # a reference's tokens

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.pred_at), np.diff(self.ref_at)[self.ref_of]

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """Each token's place among the tokens of its reference; a prediction's is -1 where that has none such."""
        return _find(self.keys, self.ref_no * self.base + self.ref), _find(self.keys, self.ref_of[self.pair_no] * self.base + self.pred)

    def clipped(self, orders: Sequence[int]) -> list[np.ndarray]:
        """Clipped n-gram matches of every pair, by order from 1 on."""
        in_ref, in_pred = self._places()
        counts, found = self.counts, []
        for n in orders:
            if n > 1:
                in_ref, in_pred, counts = _longer(in_ref, in_pred, self.ref_no, self.pair_no, len(counts))
            hit = np.flatnonzero(in_pred >= 0)
            size = max(len(counts), 1)
            grams, times = _distinct(self.pair_no[hit] * size + in_pred[hit])
            found.append(_sums(grams // size, np.minimum(times, counts[grams % size]), self.n))
        return found

    def products(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Products of the token counts: prediction by reference, and each by itself."""
        grams, times = _distinct(self.pair_no * self.base + self.pred)
        pair = grams // self.base
        at = _find(self.keys, self.ref_of[pair] * self.base + grams % self.base)
        other = np.where(at >= 0, self.counts[at], 0) if len(self.counts) else np.zeros(len(at), "int64")
        squares = _sums(self.keys // self.base, self.counts * self.counts, self.n_refs)
        return _sums(pair, times * other, self.n), _sums(pair, times * times, self.n), squares[self.ref_of]

    def subsequences(self) -> list[int]:
        """Length of the longest common subsequence of every pair: only tokens of both can be in it."""
        in_ref, in_pred = self._places()
        both = np.zeros(len(self.keys), bool)
        found = []
        for k, r in enumerate(self.ref_of):
            p = in_pred[self.pred_at[k]:self.pred_at[k + 1]]
            p = p[p >= 0]
            if not len(p):
                found.append(0)
                continue
            both[p] = True
            a = in_ref[self.ref_at[r]:self.ref_at[r + 1]]
            a = a[both[a]]
            both[p] = False
            found.append(lcs_length(a.tolist(), p.tolist()))
        return found


def _longer(in_ref: np.ndarray, in_pred: np.ndarray, ref_no: np.ndarray, pair_no: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the grams one token longer, and how often each occurs in its reference: a gram is
    the one that starts with it and the one a token later, and only those of both sides are looked at."""
    size = max(n, 1)
    p = np.flatnonzero((in_pred[:-1] >= 0) & (in_pred[1:] >= 0) & (pair_no[:-1] == pair_no[1:]))
    wanted = np.zeros(size, bool)
    wanted[in_pred[p]] = wanted[in_pred[p + 1]] = True
    seen = np.where(in_ref >= 0, wanted[in_ref], False) if n else np.zeros(len(in_ref), bool)
    r = np.flatnonzero(seen[:-1] & seen[1:] & (ref_no[:-1] == ref_no[1:]))
    ref_keys = in_ref[r] * size + in_ref[r + 1]
    keys, counts = _distinct(ref_keys)
    longer_ref, longer_pred = np.full(len(in_ref), -1), np.full(len(in_pred), -1)
    longer_ref[r] = _find(keys, ref_keys)
    longer_pred[p] = _find(keys, in_pred[p] * size + in_pred[p + 1])
    return longer_ref, longer_pred, counts


def lcs_length(a: list, b: list) -> int:
    """Bit-parallel LCS length (Allison-Dix / Hyyro recurrence)."""
    if not a or not b:
        return 0
    masks: dict = {}
    for i, tok in enumerate(a):
        masks[tok] = masks.get(tok, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for tok in b:
        u = v & masks.get(tok, 0)
        v = ((v + u) | (v ^ u)) & full
    return len(a) - bin(v).count("1")
