"""Sampling from discrete distributions by alias tables: one lookup a draw.

A distribution over n symbols becomes n cells; a cell holds a symbol, the share of the cell
that is its own, and the symbol that has the rest. One uniform number picks the cell (its whole
part) and the symbol in it (its fraction). The tables of all contexts of a language model are
one small map (alphabet squared), so a sample is an expression over its id: no join, however
many samples are drawn.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "."
CELLS = "x string, symbols array<string>, own array<double>, other array<string>"


def alias_cells(symbols: list[str], shares: list[float]) -> tuple[list[float], list[str]]:
    """Share that is a cell's own, and the symbol of its rest, for each symbol."""
    n = len(symbols)
    scaled = np.array(shares, float) / sum(shares) * n
    own, other = np.ones(n), list(symbols)
    small, large = [i for i in range(n) if scaled[i] < 1], [i for i in range(n) if scaled[i] >= 1]
    while small and large:
        s, g = small.pop(), large[-1]
        own[s], other[s] = scaled[s], symbols[g]
        scaled[g] -= 1 - scaled[s]
        if scaled[g] < 1:
            small.append(large.pop())
    return own.tolist(), other


def alias_tables(distribution: DataFrame) -> DataFrame:
    """A row of cells per context ``x`` of ``x, y, p`` (``p`` need not sum to one)."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[rows["p"] > 0].sort_values("y")
        own, other = alias_cells(rows["y"].tolist(), rows["p"].tolist())
        return pd.DataFrame({"x": [rows["x"].iloc[0]], "symbols": [rows["y"].tolist()], "own": [own], "other": [other]})
    return distribution.select("x", "y", "p").where("p > 0").groupBy("x").applyInPandas(build, CELLS)


def uniform(*of: Column) -> Column:
    """A uniform number in [0, 1) from a hash of the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def sampled_words(samples: DataFrame, tables: DataFrame, seed: int = 0, max_len: int = 20) -> DataFrame:
    """``sample_id, word, ended`` for every row of ``samples`` (``sample_id, seed_char``): symbols drawn one after
    the other from ``seed_char`` on, until the end symbol or ``max_len`` of them."""
    cells = F.map_from_entries(F.collect_list(F.struct("x", F.struct("symbols", "own", "other").alias("cells"))))
    table = tables.agg(cells.alias("m")).scalar()
    drawn = samples.withColumn("__m", table)

    def step(state: Column, k: Column) -> Column:
        cell = F.element_at("__m", state["last"])
        at = uniform(F.lit(seed), F.col("sample_id"), k) * F.size(cell["symbols"])
        i = F.floor(at).cast("int")
        symbol = F.when(at - i < F.get(cell["own"], i), F.get(cell["symbols"], i)).otherwise(F.get(cell["other"], i))
        go = F.struct(F.when(symbol == END, state["word"]).otherwise(F.concat(state["word"], symbol)).alias("word"), symbol.alias("last"),
                      (symbol == END).alias("ended"))
        return F.when(state["ended"], state).otherwise(go)

    start = F.struct(F.lit("").alias("word"), F.col("seed_char").alias("last"), F.lit(False).alias("ended"))
    done = F.aggregate(F.sequence(F.lit(0), F.lit(max_len - 1)), start, step)
    return drawn.select("sample_id", "seed_char", done.alias("s")).select("sample_id", "seed_char", "s.word", "s.ended")


def transitions(words: DataFrame) -> DataFrame:
    """``x, y, n``: how often a symbol followed another in sampled words, the end included where it was drawn."""
    path = F.concat("seed_char", "word", F.when(F.col("ended"), F.lit(END)).otherwise(F.lit("")))
    pairs = F.transform(F.sequence(F.lit(1), F.length(path) - 1), lambda i: F.substring(path, i, F.lit(2)))
    return (words.where(F.length(path) > 1).select(F.explode(pairs).alias("pair"))
            .groupBy("pair").agg(F.count(F.lit(1)).alias("n")).select(F.substring("pair", 1, 1).alias("x"), F.substring("pair", 2, 1).alias("y"), "n"))
