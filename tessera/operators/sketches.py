"""Quantile sketches that are stored per period and merged later.

``percentile_approx`` answers once and is gone. A KLL sketch is a small binary value: one per
day is stored next to the data, and any span of days is answered from its sketches alone,
with a bounded rank error. A day that is loaded again only replaces its own sketch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch: the rank error is about 1 / K to the power 0.9 (some 0.4 % for 400).
K = 400


def sketches_by(rows: DataFrame, period: Column, value: str, k: int = K) -> DataFrame:
    """``period, n, sketch``: one sketch of the non-null values of each period."""
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k))
    return rows.where(F.col(value).isNotNull()).groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Sketches of the given periods replace the stored ones of these periods."""
    (sketches.repartition("period").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path))


def merged_quantiles(sketches: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by..., n, share, value``: quantiles of all periods of a group, from their sketches."""
    one = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    answers = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value")) for s in shares]))
    return one.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), answers.alias("a")).select(*by, "n", "a.share", "a.value")
