"""Deterministic stand-ins for models that are not available offline."""

from __future__ import annotations

import re
import zlib

import numpy as np

from tessera.operators.udf import Model

_TOKEN = re.compile(r"[a-z0-9]+")


def hashing_embedder(dim: int = 64) -> Model:
    """Feature hashing: tokens go to ``dim`` signed buckets by CRC32 and the vector is
    L2-normalised; a text without tokens gives the zero vector."""
    def load():
        def fn(texts):
            out = np.zeros((len(texts), dim), dtype="float64")
            for i, t in enumerate(texts):
                for tok in _TOKEN.findall((t or "").lower()):
                    h = zlib.crc32(tok.encode("utf-8"))
                    out[i, h % dim] += 1.0 if (h >> 31) & 1 == 0 else -1.0
            n = np.linalg.norm(out, axis=1, keepdims=True)
            out = np.divide(out, n, out=np.zeros_like(out), where=n > 0)
            return list(out)
        return fn
    return Model("feature-hashing", str(dim), load)
