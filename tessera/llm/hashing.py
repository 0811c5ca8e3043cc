"""64-bit rolling hashes over numpy byte arrays."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A fixed random 64-bit value for every byte, so that similar bytes do not give similar sums.
BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(BASE))


class PolynomialHash:
    """Hashes of substrings as differences of prefix sums, modulo 2**64.

    ``hash(b[i:j]) = sum(value(b[k]) * BASE**(k - i))``: equal substrings hash alike
    wherever they stand. Powers are grown to the longest array seen.
    """

    def __init__(self):
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 1 << 16)
            for name, base in (("powers", BASE), ("inverses", INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        """``len(raw) + 1`` prefix sums."""
        self.grow(len(raw) + 1)
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(BYTE_VALUES[raw] * self.powers[:len(raw)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.inverses[start])

    def windows(self, raw: np.ndarray, width: int) -> np.ndarray:
        """Hash of every window of ``width`` bytes, by its start."""
        sums = self.prefix(raw)
        return mix((sums[width:] - sums[:-width]) * self.inverses[:len(raw) - width + 1])
