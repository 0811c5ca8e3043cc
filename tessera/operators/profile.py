"""Corpus and table profiling: counts, coverage, quantiles, histograms, top-k.

All of it is aggregate plans with partial (map-side) aggregation. Scalars
derived from the data (min, max, quantile cut points) enter later stages as
scalar subqueries (``DataFrame.scalar()``), so no data-sized side is joined.
Exact percentiles of integer-valued columns (lengths) use Spark's
``percentile`` aggregate, whose buffer is a value -> count map bounded by the
number of *distinct* values; continuous columns use ``exact_quantiles``
(range narrowing), which never gathers the values in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NONE_LABEL = "(none)"


def round_half_up_int(c: Column) -> Column:
    """Postgres ``numeric::int`` (half away from zero for the positive values here)."""
    return F.round(c, 0).cast("long")


def money(c: Column) -> Column:
    """Amounts as ``DECIMAL(12,2)``: sums of them are exact."""
    return c.cast("decimal(12,2)")


def typed_orders(orders: DataFrame) -> DataFrame:
    """``o_orderkey, order_date DATE, total DECIMAL(12,2), total_int, order_id``."""
    return orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"),
                         money(F.col("o_totalprice")).alias("total"), round_half_up_int(F.col("o_totalprice")).alias("total_int"),
                         F.col("o_orderkey").cast("string").alias("order_id"))


def monthly_totals(df: DataFrame, at: str, amount: str) -> DataFrame:
    """``month DATE, n_orders, revenue DECIMAL``, by month."""
    month = F.trunc(F.col(at).cast("date"), "month").alias("month")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money(F.col(amount))).alias("revenue")).orderBy("month")


def length_profile(df: DataFrame, col: str) -> DataFrame:
    n = F.length(F.col(col))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.col(col)).alias("n_present"),
        round_half_up_int(F.avg(n)).alias("avg_len"),
        F.rint(F.percentile(n, 0.5)).cast("long").alias("p50_len"),
        F.rint(F.percentile(n, 0.95)).cast("long").alias("p95_len"),
        F.max(n).alias("max_len"),
    )


def value_counts(df: DataFrame, col: Column, k: int = 15, fill: str = NONE_LABEL) -> DataFrame:
    v = F.coalesce(col.cast("string"), F.lit(fill)).alias("value")
    g = df.groupBy(v).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), F.col("value")).limit(k)


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percent non-null per field (1 decimal), long form, fullest first, one aggregate pass."""
    wide = df.agg(*[F.round(F.avg(F.col(c).isNotNull().cast("double")) * 100.0, 1).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (field, pct_present)").orderBy(F.desc("pct_present"), "field")


def describe_numeric(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std, min, quartiles, max. Values are counted first, so what one task merges
    for the quartiles is the distinct values, in one map; for a continuous column see ``exact_quantiles``."""
    x = F.col(col)
    counted = df.where(x.isNotNull()).groupBy(x.alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    quartiles = counted.agg(F.percentile("_x", [0.25, 0.5, 0.75], F.col("_n")).alias("_q"))
    plain = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    q = [F.get("_q", i).alias(name) for i, name in enumerate(("p25", "p50", "p75"))]
    return plain.join(F.broadcast(quartiles)).select("count", "mean", "std", "min", *q, "max")  # one row and one row


def median_by_group(df: DataFrame, by: str, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Rounded medians of several columns per group, ``<col>_median``, highest first of the first.

    Values are counted per group first, so what one task merges for a group is its
    distinct values and not its rows.
    """
    parts = []
    for c in cols:
        counted = df.where(F.col(c).isNotNull()).groupBy(by, c).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(counted.groupBy(by).agg(F.round(F.percentile(c, 0.5, F.col("_n")), 1).alias(f"{c}_median")))
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    for p in parts:
        out = out.join(p, by, "left")
    order = [F.col(f"{cols[0]}_median").desc(), F.col(by)]
    return out.orderBy(*order).limit(top) if top else out.orderBy(*order)


def group_mean_std(df: DataFrame, by: str, metrics: Sequence[str], order: Sequence[str] | None = None,
                   digits: int = 4) -> DataFrame:
    aggs = []
    for m in metrics:
        aggs += [F.round(F.avg(m), digits).alias(f"{m}_mean"), F.round(F.stddev_samp(m), digits).alias(f"{m}_std")]
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *aggs)
    if order:
        rank = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(by))
        g = g.orderBy(rank)
    return g


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Degree-1 least squares y = slope * x + intercept."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))


def _value_at_rank(vals: DataFrame, rank: int, n: int, buckets: int) -> float:
    """Exact ``rank``-th (0-based, ascending) value of the one-column frame ``vals`` (``_x``).

    Range narrowing: equal-width buckets over the current [min, max] are
    counted (at most ``buckets`` rows reach the driver), the walk finds the
    bucket holding the rank, and only that bucket is kept for the next round.
    Every round keeps the min in the first and the max in the last bucket, so
    the candidate set shrinks until its values are equal. Values must be finite.
    """
    cond = F.lit(True)
    x = F.col("_x")
    lo_hi = vals.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi, base = lo_hi["lo"], lo_hi["hi"], 0
    while True:
        if lo == hi:
            return float(lo)
        width = hi / buckets - lo / buckets  # the difference itself may overflow
        if width > 0 and lo + width > lo:
            b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1)).cast("int")
        else:  # neighbouring doubles: no equal-width bucket separates them, the least value does
            b = (x > F.lit(lo)).cast("int")
        rows = sorted(vals.where(cond).groupBy(b.alias("_b"))
                      .agg(F.count(F.lit(1)).alias("c"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect())
        for row in rows:
            if rank < base + row["c"]:
                cond = cond & (b == F.lit(row["_b"]))
                lo, hi = row["lo"], row["hi"]
                break
            base += row["c"]
        else:  # rank past the end
            raise ValueError("rank out of range")


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], buckets: int = 4096) -> list[float | None]:
    """Interpolated quantiles (``percentile`` / ``quantile_cont`` semantics), scale-safe.

    Spark's exact ``percentile`` merges a map of every distinct value into one
    task, which is unbounded for a continuous column. Here the values are
    checkpointed once (one column) and each needed rank is found by range
    narrowing; what reaches the driver is bucket counts and single values.
    """
    from tessera.session import cut_lineage
    vals = cut_lineage(df.select(F.col(col).cast("double").alias("_x"))
                         .where(F.col("_x").isNotNull() & ~F.isnan("_x")))
    # infinities stand at the ends of the order and are counted, not narrowed
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    sizes = vals.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_x") == low, 1)).alias("low"),
                     F.count(F.when(F.col("_x") == high, 1)).alias("high")).first()
    n = sizes["n"]
    if n == 0:
        return [None for _ in qs]
    finite = vals.where((F.col("_x") > low) & (F.col("_x") < high))
    cache: dict[int, float] = {}

    def at(r: int) -> float:
        if r not in cache:
            if r < sizes["low"]:
                cache[r] = float("-inf")
            elif r >= n - sizes["high"]:
                cache[r] = float("inf")
            else:
                cache[r] = _value_at_rank(finite, r - sizes["low"], n - sizes["low"] - sizes["high"], buckets)
        return cache[r]

    out = []
    for q in qs:
        h = (n - 1) * float(q)
        r0 = int(h)
        r1 = min(r0 + 1, n - 1)
        v0 = at(r0)
        out.append(v0 if r1 == r0 or h == r0 or at(r1) == v0 else v0 + (h - r0) * (at(r1) - v0))
    return out


def quantile_buckets(df: DataFrame, col: str, lo_q: float = 0.33, hi_q: float = 0.67,
                     labels=("low", "mid", "high"), out: str = "bucket") -> DataFrame:
    """low <= q_lo < mid <= q_hi < high, with exact interpolated quantiles."""
    lo, hi = exact_quantiles(df, col, (lo_q, hi_q))
    x = F.col(col)
    b = F.when(x <= F.lit(lo), F.lit(labels[0])).when(x <= F.lit(hi), F.lit(labels[1])).otherwise(F.lit(labels[2]))
    return df.withColumn(out, b)


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max]; the max lands in the last bin."""
    mm = df.select(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    lo = mm.select("lo").scalar()
    hi = mm.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    raw = F.when(width > 0, F.floor((F.col(col) - lo) / width)).otherwise(F.lit(0))
    b = F.least(raw.cast("long"), F.lit(bins - 1))
    g = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("bin", (lo + F.col("bin") * width).alias("lower"),
                    (lo + (F.col("bin") + 1) * width).alias("upper"), "n")


def clipped(value: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """The value moved into ``[lo, hi]``; a null stays null, and a bound that is ``None`` does not bind."""
    out = value if lo is None else F.when(value.isNotNull(), F.greatest(value, F.lit(lo)))
    return out if hi is None else F.when(value.isNotNull(), F.least(out, F.lit(hi)))


def clipped_histogram(df: DataFrame, col: str, lo: int, hi: int, width: int) -> DataFrame:
    """``bin, n`` over bins of ``width`` from ``lo`` on; values outside are counted in the first and last bin."""
    at = F.floor((clipped(F.col(col), lo, hi) - F.lit(lo)) / F.lit(width)).cast("long")
    return df.where(F.col(col).isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n")).orderBy("bin")


def top_k_groups(df: DataFrame, by: str, k: int) -> DataFrame:
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.col("n").desc(), F.col(by)).limit(k)


def rank_labels(topk: DataFrame, by: str) -> DataFrame:
    """Label -> 0-based index by descending count on the (k-row) top-k frame."""
    w = Window.orderBy(F.col("n").desc(), F.col(by))
    return topk.withColumn("label_idx", F.row_number().over(w) - 1)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()
    return g.withColumn("share", F.col("n") / F.sum("n").over(w)) \
            .withColumn("majority_share", F.max("n").over(w) / F.sum("n").over(w))


def confusion_matrix(pred: DataFrame, y: str, yhat: str, classes: DataFrame) -> DataFrame:
    """Dense k x k counts (zeros kept). ``classes`` is the small label frame."""
    counts = pred.groupBy(F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    # k x k grid from the k-element class array, expanded inside one row.
    arr = classes.agg(F.array_sort(F.collect_set(F.col(classes.columns[0]))).alias("_c"))
    grid = arr.select(F.explode("_c").alias("actual"), "_c").select("actual", F.explode("_c").alias("predicted"))
    return grid.join(counts, ["actual", "predicted"], "left").fillna(0, ["n"])


def accuracy(pred: DataFrame, y: str, yhat: str) -> Column:
    return F.avg((F.col(y) == F.col(yhat)).cast("double"))


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last record per key by ``order`` (a total order), via ``max_by`` over a struct (a sort-based aggregate)."""
    others = [c for c in df.columns if c not in keys]
    o = F.struct(*[F.col(c) for c in order])
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), o).alias("_last"))
    return g.select(*keys, *[F.col("_last")[c].alias(c) for c in others])


def top_n(df: DataFrame, col: str, n: int, tie: str, largest: bool = True) -> DataFrame:
    o = F.col(col).desc() if largest else F.col(col).asc()
    return df.orderBy(o, F.col(tie)).limit(n)
