"""Join helpers: dimension enrichment, semi/anti joins, lookups, alignment.

No side is forced to be broadcast: Spark does so by byte size, estimated or, with
AQE, measured, and otherwise shuffles with skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Fact x dimension equi-join."""
    return fact.join(dim, on, how)


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_anti")


def lookup_with_fallback(df: DataFrame, lookup: DataFrame, left_key, right_key: str, value_col: str,
                         out_col: str, fallback: str = "") -> DataFrame:
    """Left lookup; a missing or empty value becomes ``fallback``."""
    lk = lookup.select(F.col(right_key).alias("_lk"), F.col(value_col).alias("_lv"))
    j = df.join(lk, left_key == F.col("_lk"), "left")
    return j.withColumn(out_col, F.coalesce(F.when(F.col("_lv") != "", F.col("_lv")), F.lit(fallback))) \
            .drop("_lk", "_lv")


def align(a: DataFrame, b: DataFrame, on: str, suffixes=("_a", "_b")) -> DataFrame:
    """Full outer alignment of two keyed frames; the key is coalesced."""
    ra = a.select([F.col(c).alias(c + suffixes[0]) if c != on else F.col(c).alias("_ka") for c in a.columns])
    rb = b.select([F.col(c).alias(c + suffixes[1]) if c != on else F.col(c).alias("_kb") for c in b.columns])
    j = ra.join(rb, F.col("_ka") == F.col("_kb"), "full_outer")
    return j.withColumn(on, F.coalesce("_ka", "_kb")).drop("_ka", "_kb")
