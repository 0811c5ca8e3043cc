"""Deterministic, order-independent splits with exact sizes.

Rows are ordered by ``key = (md5(id ':' seed), id)`` - uniform, reproducible,
independent of input order - and the first ``floor(f * n)`` keys form the
first split. Materialising a global rank would sort every row in one task,
so instead each cut point is located as a *key*:

1. rows are counted by a hex prefix of the hash (a map-side combined
   aggregate), which names the one prefix that holds the cut rank;
2. rows under that prefix are counted by a longer prefix, and so on, until few
   enough rows share the prefix to list them: no task ever orders a bucket.

Every row is then tagged by comparing its key with the cut keys - a narrow,
map-side expression, no shuffle of the data and nothing persisted. What reaches
the driver per class and cut: at most ``16**DIGITS`` counts and ``LISTED`` keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage

DIGITS = 4
LISTED = 4096
HASH_DIGITS = 32
#: How far from its expected place a cut is sought in one pass: ten standard deviations for ten million rows.
NEAR = 1 / 1024


def split_hash(id_col: Column, seed: int | str) -> Column:
    return F.md5(F.concat_ws(":", id_col.cast("string"), F.lit(str(seed))))


def _key(id_col: Column, seed) -> tuple[Column, Column]:
    return split_hash(id_col, seed), id_col.cast("string")


def _count_by_prefix(keys: DataFrame, targets: set[tuple], length: int, by: list[str]) -> dict[tuple, list[tuple[str, int]]]:
    """Counts by hash prefix of ``length`` digits under the (class, prefix) targets."""
    rows = keys
    if any(prefix for _, prefix in targets):
        known = {p for _, p in targets}
        n = len(next(iter(known)))
        rows = keys.where(F.substring("_h", 1, n).isin(sorted(known)))
    found: dict[tuple, list[tuple[str, int]]] = {}
    for r in rows.groupBy(*by, F.substring("_h", 1, length).alias("_p")).agg(_rows(keys).alias("_n")).collect():
        found.setdefault(tuple(r[c] for c in by), []).append((r["_p"], r["_n"]))
    return {c: sorted(x) for c, x in found.items()}


def _rows(keys: DataFrame) -> Column:
    """How many rows there are, or stand for, where ``_w`` says so."""
    return F.sum("_w") if "_w" in keys.columns else F.count(F.lit(1))


def cut_keys(keys: DataFrame, ranks_of, by: list[str] | None = None, digits: int = DIGITS,
             listed: int = LISTED) -> dict[tuple, list[tuple[str, str] | None]]:
    """Per class, the key ``(_h, _id)`` at each of its 0-based ranks (``None`` past the end).

    ``ranks_of(n)`` gives the ranks for a class of ``n`` rows; ``keys`` has ``_h, _id`` and
    the ``by`` columns; with ``_w`` a row stands for so many.
    """
    by = by or []
    length = digits
    counts = _count_by_prefix(keys, {((), "")}, length, by)
    out: dict[tuple, list] = {}
    pending: list[tuple[tuple, int, str, int, int]] = []  # class, cut, prefix, rank under it, rows under it
    for c, x in counts.items():
        n = sum(k for _, k in x)
        ranks = ranks_of(n)
        out[c] = [None] * len(ranks)
        pending += [(c, i, *_descend(x, rank)) for i, rank in enumerate(ranks) if rank < n]
    while pending:
        small = [t for t in pending if t[4] <= listed or len(t[2]) >= HASH_DIGITS]
        for k, group in _by_length(small).items():
            wanted = keys.where(F.substring("_h", 1, k).isin(sorted({t[2] for t in group})))
            # repeated ids share a key: counted, not listed one by one
            rows = wanted.groupBy(*by, "_h", "_id").agg(_rows(keys).alias("_n")).collect()
            for c, i, prefix, rank, _ in group:
                under = sorted((r["_h"], r["_id"], r["_n"]) for r in rows
                               if tuple(r[b] for b in by) == c and r["_h"].startswith(prefix))
                out[c][i] = _at_rank(under, rank)
        pending = [t for t in pending if not (t[4] <= listed or len(t[2]) >= HASH_DIGITS)]
        if pending:
            length = min(length + digits, HASH_DIGITS)
            counts = _count_by_prefix(keys, {(t[0], t[2]) for t in pending}, length, by)
            pending = [(c, i, *_descend([x for x in counts[c] if x[0].startswith(prefix)], rank))
                       for c, i, prefix, rank, _ in pending]
    return out


def _by_length(items: list[tuple]) -> dict[int, list[tuple]]:
    found: dict[int, list[tuple]] = {}
    for t in items:
        found.setdefault(len(t[2]), []).append(t)
    return found


def _descend(counts: list[tuple[str, int]], rank: int) -> tuple[str, int, int]:
    """Prefix that holds the rank, the rank under it, and its row count."""
    for prefix, n in counts:
        if rank < n:
            return prefix, rank, n
        rank -= n
    raise ValueError("rank past the end")


def _at_rank(rows: list[tuple[str, str, int]], rank: int) -> tuple[str, str]:
    for h, i, n in rows:
        if rank < n:
            return h, i
        rank -= n
    raise ValueError("rank past the end")


def _before(h: Column, i: Column, cut: tuple[str, str] | None) -> Column:
    """Whether a row's key sorts before the cut; all do where there is none."""
    if cut is None:
        return F.lit(True)
    return (h < F.lit(cut[0])) | ((h == F.lit(cut[0])) & (i < F.lit(cut[1])))


def exact_hash_split(df: DataFrame, id_col: str, fractions: Sequence[float] = (0.8, 0.1),
                     names: Sequence[str] = ("train", "val", "test"), seed: int | str = 42,
                     split_col: str = "split") -> DataFrame:
    """Tag rows with split names; sizes are ``floor(f * n)`` for all but the last.

    The cut keys are found by counting passes over the ids; the returned plan tags
    the rows with a literal comparison, i.e. no shuffle and no subquery.
    """
    assert len(names) == len(fractions) + 1
    h, i = _key(F.col(id_col), seed)

    def ranks_of(n: int) -> list[int]:
        ranks, cut = [], 0
        for f in fractions:
            cut += int(float(f) * n)
            ranks.append(cut)
        return ranks

    cuts = cut_keys(df.select(h.alias("_h"), i.alias("_id")), ranks_of).get((), [None] * len(fractions))
    keyed = df.withColumn("_h", h)
    expr = None
    for name, ck in zip(names[:-1], cuts):
        cond = _before(F.col("_h"), i, ck)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return keyed.withColumn(split_col, expr.otherwise(F.lit(names[-1]))).drop("_h")


def split_counts(df: DataFrame, id_col: str, fraction: float, names: Sequence[str], by: Sequence[str],
                 seed: int | str = 42, split_col: str = "split", near: float = NEAR) -> DataFrame | None:
    """Rows per split and ``by`` columns, as ``exact_hash_split`` would tag them, from one pass over ``df``.

    The share of rows below a hash is close to that hash's place in the hash space, so the cut is
    sought within ``near`` of its place: rows outside are counted at once, those inside keep
    their keys and are counted when the cut is known. ``None`` where the cut is not inside (few
    rows, or ids that repeat); then the rows have to be tagged by passes over them.
    """
    h, i = _key(F.col(id_col), seed)
    lo, hi = (format(min(max(int(x * 16**8), 0), 16**8 - 1), "08x") for x in (fraction - near, fraction + near))
    zone = F.when(F.col("_h") < lo, -1).when(F.col("_h") < hi, 0).otherwise(1)
    inside = (F.col("_h") >= lo) & (F.col("_h") < hi)
    rows = df.select(*by, h.alias("_h"), i.alias("_id")).select(
        *by, zone.alias("_zone"), F.when(inside, F.col("_h")).alias("_h"), F.when(inside, F.col("_id")).alias("_id"))
    counted = cut_lineage(rows.groupBy(*by, "_zone", "_h", "_id").agg(F.count(F.lit(1)).alias("_w")))
    n = {r["_zone"]: r["n"] for r in counted.groupBy("_zone").agg(F.sum("_w").alias("n")).collect()}
    rank = int(float(fraction) * sum(n.values())) - n.get(-1, 0)  # of the cut among the rows inside
    if not 0 <= rank < n.get(0, 0):
        return None
    keys = counted.where("_zone = 0").select("_h", "_id", "_w")
    cut = cut_keys(keys, lambda _: [rank])[()][0]
    first = (F.col("_zone") < 0) | ((F.col("_zone") == 0) & _before(F.col("_h"), F.col("_id"), cut))
    tagged = counted.select(*by, F.when(first, F.lit(names[0])).otherwise(F.lit(names[1])).alias(split_col), "_w")
    return tagged.groupBy(*by, split_col).agg(F.sum("_w").alias("c"))


def stratified_split(df: DataFrame, id_col: str, by: str, test_fraction: float = 0.2,
                     seed: int | str = 42, split_col: str = "split") -> DataFrame:
    """Per-class exact split: the first ``floor(f * n_class)`` rows by hash key are test.

    One cut key per class (a class is a label: there are few), then a map-side
    comparison; neither rows nor classes are shuffled to be tagged.
    """
    h, i = _key(F.col(id_col), seed)
    cuts = cut_keys(df.select(h.alias("_h"), i.alias("_id"), F.col(by).alias("_c")),
                    lambda n: [int(float(test_fraction) * n)], ["_c"])
    keyed = df.withColumn("_h", h)
    test = F.lit(False)
    for (c,), (cut,) in sorted(cuts.items(), key=lambda x: str(x[0])):
        test = test | (F.col(by).eqNullSafe(F.lit(c)) & _before(F.col("_h"), i, cut))
    return keyed.withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train"))).drop("_h")
