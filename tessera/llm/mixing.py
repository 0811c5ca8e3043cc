"""Mixing sources to target weights by subset-sum budget fitting.

Targets: the sources share the whole corpus size by weight; a target stops at
``max_repeats`` times its source's size and the excess is shared again by weight
among the others until none is above. Within a source, whole epochs come first;
what is left of the target is fitted on the histogram of document lengths alone:
every length gives its proportional share, and a bounded-knapsack dynamic
program over the lengths still free spends the rest, a longest document and more. The histogram then
says how many documents of each length to take; which ones, a seeded hash
decides.

Work: one scan for the sizes, aggregates with partial sums, one grouped task per
source over its length histogram (never over its documents), and a selection
that spreads documents of one source and length over hash buckets, so that a
source with a third of all rows, or one length repeated endlessly, is no hot
task. The per-source table (one row per source) is the only thing sorted whole.

Defined results: null text has size 0; documents of size 0 are never taken; the
null source comes last and is a source like others; sources without words get
target 0; an empty table gives an empty mix. Rows that repeat an id are separate
documents; identical ones may be told apart by nothing, so their seeded order is
arbitrary among equals but the mix's totals are not. Reruns agree. Only id, text
and source are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import hashing
from tessera.session import cut_lineage

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = 20
BUCKETS = 64
#: Words that the dynamic program spends beside the longest document, and bytes of its tables, about.
REST = 1 << 15
TABLE_BYTES = 1 << 26


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows.

    Each round is one aggregate to two numbers; a round caps at least one more
    source or is the last.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    totals = cut_lineage(totals.withColumn("weight", F.element_at(cycle, (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int")))
                         .withColumn("cap", F.col("source_size").cast("double") * max_repeats))
    full = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"]
    level = float("-inf")  # words per unit of weight; sources whose cap lies below are capped
    while True:
        open_ = F.col("cap") > F.col("weight") * level
        r = totals.agg(F.sum(F.when(open_, F.col("weight"))).alias("w"),
                       F.sum(F.when(~open_, F.col("cap"))).alias("capped")).first()
        if r["w"] is None:
            break
        new = (float(full) - (r["capped"] or 0.0)) / r["w"]
        if new <= level:
            break
        level = new
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return totals.select("source", "source_size", target.alias("target"))


def seeded_order(lengths: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths in an order that a hash decides, and the hashes as shares of one."""
    h = hashing.mix(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    return np.argsort(h, kind="stable"), h.astype(np.float64) / 2.0 ** 64


def best_sum(lengths: np.ndarray, free: np.ndarray, order: np.ndarray, left: int, unit: int) -> np.ndarray:
    """How many of the free documents of each length sum closest to ``left``, never above it: a
    bounded knapsack over sums in steps of ``unit`` (lengths are rounded up to it)."""
    chosen, top = np.zeros(len(lengths), np.int64), left // unit
    # bit s of ``reach`` after a step: some choice so far sums to s
    steps, reach, mask = [], 1, (1 << top + 1) - 1
    for k in order.tolist():
        size = -(-int(lengths[k]) // unit)
        n_free, part = min(int(free[k]), top // size), 1
        while n_free > 0:
            n = min(part, n_free)
            more = reach | (reach << n * size & mask)
            if more != reach:
                steps.append((k, n, size, reach))
                reach = more
            n_free -= n
            part *= 2
        if reach >> top & 1:
            break
    best = reach.bit_length() - 1
    for k, n, size, before in reversed(steps):
        if not before >> best & 1:
            chosen[k] += n
            best -= n * size
    return chosen


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, rest: int = REST, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their sum is close to ``budget``.

    Never above it. Proportional shares of every length come first, rounded down; while more
    is left than the longest document and ``rest`` words, lengths in a seeded order get the document
    that rounding took, or more. A bounded knapsack over the counts still free spends what is left:
    its bound exceeds the longest document, so that one is considered too. Sums are in steps of the
    lengths' common divisor, or coarser where the tables would outgrow ``TABLE_BYTES``; what
    coarse steps leave is fitted again in fine ones.
    """
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    take[:] = [int(c) * budget // total for c in counts]
    left = budget - int((take * lengths).sum())
    order, chance = seeded_order(lengths, seed)
    bound = int(lengths.max()) + rest
    for again in (False, True):  # first what rounding took, by chance of its size; then whatever is free
        for k in order.tolist():
            if left <= bound:
                break
            n = min(int(counts[k] - take[k]), -(-(left - bound) // int(lengths[k])))
            if not again:
                n = min(n, int(chance[k] < int(counts[k]) * budget % total / total))
            take[k] += n
            left -= n * int(lengths[k])
    divisor = int(np.gcd.reduce(lengths))
    while left >= divisor:
        free = counts - take
        steps = int(np.log2(np.minimum(free, left // lengths) + 1).sum()) + 1
        unit = divisor * max(1, -(-left * steps // (8 * TABLE_BYTES * divisor)))
        more = best_sum(lengths, free, order, left, unit)
        if not more.any():
            break
        take += more
        left -= int((more * lengths).sum())
        if unit == divisor:
            break
    return take


def fitted_counts(histogram: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, size, epochs, extra`` from ``source, size, n, source_size, target``:
    every document ``epochs`` times and ``extra`` documents of that length once more."""
    def per_source(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        total, target = int(rows["source_size"][0]), float(rows["target"][0])
        epochs = min(int(target // total), max_repeats)
        budget = 0 if epochs == max_repeats else round(target) - epochs * total
        extra = fit_budget(rows["size"].to_numpy(), rows["n"].to_numpy(), budget)
        return pd.DataFrame({"source": rows["source"], "size": rows["size"], "epochs": np.int64(epochs), "extra": extra})

    return (histogram.where("size > 0").groupBy("source")
            .applyInPandas(per_source, "source string, size long, epochs long, extra long"))


def seeded_bucket(doc_id: Column, text_hash: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, text_hash)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, copies, taken``
    and ``text_hash``, which tells apart rows that share an id."""
    order = seeded_bucket(F.col("doc_id"), F.col("text_hash"), seed)
    sized = (docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                         word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_hash"))
             .withColumn("order", order).withColumn("bucket", F.pmod("order", F.lit(BUCKETS))))
    sized = cut_lineage(sized)  # a row of numbers per document: four later reads would scan the texts again
    by_bucket = sized.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    by_bucket = cut_lineage(by_bucket)
    targets = source_targets(by_bucket.select("source", (F.col("size") * F.col("n")).alias("size")), weights, max_repeats)
    lengths = by_bucket.groupBy("source", "size").agg(F.sum("n").alias("n"))
    fitted = fitted_counts(null_safe_join(lengths, targets, ["source"]), max_repeats)
    # buckets in order: whole ones are taken until the count is met inside one, where rows are ranked
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (null_safe_join(by_bucket, fitted, ["source", "size"], "left")
            .withColumn("free", F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0)))
            .select("source", "size", "bucket", F.coalesce("epochs", F.lit(0)).alias("epochs"),
                    F.greatest(F.lit(0), F.least("n", F.coalesce("free", F.lit(0)))).alias("once_more"), "n"))
    plan = null_safe_join(plan, targets, ["source"])
    rows = null_safe_join(sized, plan, ["source", "size", "bucket"])
    cut = F.col("once_more").between(F.lit(1), F.col("n") - 1)
    whole = rows.where(~cut).withColumn("rank", F.when(F.col("once_more") > 0, 1).otherwise(F.col("n") + 1))
    ranked = rows.where(cut).withColumn("rank", F.row_number().over(
        Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id", "text_hash")))
    copies = F.col("epochs") + F.when(F.col("rank") <= F.col("once_more"), 1).otherwise(0)
    return (whole.unionByName(ranked)
            .select("doc_id", "text_hash", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null; the result keeps the left side's keys."""
    renamed = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns if c in keys or c not in left.columns])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])
