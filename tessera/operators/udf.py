"""Model hooks: text generators (U1) and embedders (U2) as Arrow batch operators.

A ``Model`` names what it loads: workers keep one loaded model per name and
version, so two models in one worker never stand in for each other.
``mapInPandas`` feeds it whole Arrow batches. A failing batch falls back to
row-by-row calls so one bad row yields an error value for that row instead of
failing the task; errors land in an ``error`` column that callers route to a
side table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Model:
    """``load()`` builds ``fn(list[str]) -> list``; ``name`` and ``version`` must tell models apart."""

    name: str
    version: str
    load: Callable[[], Callable]


_LOADED: dict[tuple[str, str], Callable] = {}


def _model(model: Model) -> Callable:
    key = (model.name, model.version)
    if key not in _LOADED:
        _LOADED[key] = model.load()
    return _LOADED[key]


def _apply(fn: Callable, texts: list) -> tuple[list, list]:
    try:
        return list(fn(texts)), [None] * len(texts)
    except Exception:  # noqa: BLE001 - retry per row to isolate the failure
        out, err = [], []
        for t in texts:
            try:
                out.append(fn([t])[0])
                err.append(None)
            except Exception as e:  # noqa: BLE001
                out.append(None)
                err.append(str(e))
        return out, err


def generate(df: DataFrame, input_col: str, model: Model, out_col: str = "prediction") -> DataFrame:
    """Run a text generator over ``input_col``; adds ``out_col`` and ``error``."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType()),
                                              T.StructField("error", T.StringType())])

    def run(batches):
        fn = _model(model)
        for pdf in batches:
            out, err = _apply(fn, pdf[input_col].tolist())
            yield pdf.assign(**{out_col: out, "error": err})

    return df.mapInPandas(run, schema)


def embed(df: DataFrame, text_col: str, model: Model, out_col: str = "embedding") -> DataFrame:
    """Embed ``text_col`` into ``ARRAY<FLOAT>``; adds ``out_col`` and ``error``."""
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.ArrayType(T.FloatType())),
                                              T.StructField("error", T.StringType())])

    def run(batches):
        fn = _model(model)
        for pdf in batches:
            out, err = _apply(fn, pdf[text_col].tolist())
            yield pdf.assign(**{out_col: [None if v is None else np.asarray(v, dtype="float32") for v in out],
                                "error": err})

    return df.mapInPandas(run, schema)
