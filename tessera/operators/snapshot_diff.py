"""Differences between two states of a keyed table, deletes included.

Both states are digested per bucket of keys: number of rows and an order-free sum of
128 bits of row digests. Buckets that agree are skipped; only rows of the others are joined
(full outer, by key) into ``insert``, ``update`` and ``delete`` rows. For a key with an order
the buckets are ranges, so new and changed rows, which mostly lie together, leave most buckets
alone, and the ranges that differ are pushed to both scans as conditions on the key. Any other
key is bucketed by hash.

Incremental extraction never sees a deleted row (nothing newer than the watermark is left
of it); applying the difference between the source and the replica repairs that without a
full swap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets that two states are digested in; a row of each is compared, so this bounds what the driver sees.
BUCKETS = 256


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit digests of a row; a null counts as a value of its own, told apart by its position."""
    nulls = F.concat_ws("", *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return [F.xxhash64(F.lit(seed), nulls, *columns) for seed in (1, 2)]


def bucket_digests(rows: DataFrame, bucket: Column, columns: Sequence[str]) -> DataFrame:
    """``bucket, n, digest``: sums of digests, which no order of rows can change."""
    a, b = row_digest(columns)
    wide = "decimal(38,0)"
    return rows.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.struct(F.sum(a.cast("decimal(20,0)")).cast(wide).alias("a"), F.sum(b.cast("decimal(20,0)")).cast(wide).alias("b")).alias("digest"))


def key_bounds(rows: DataFrame, key: str, buckets: int) -> list:
    """Increasing values that cut the keys into ranges of about equal size."""
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.percentile_approx(key, shares, 20 * buckets).alias("b")).first()["b"] if shares else None
    return sorted(set(found or []))


def range_bucket(key: str, bounds: Sequence, dtype: T.DataType) -> Column:
    """Number of bounds that are not above the key (null keys: before all)."""
    values = F.array(*[F.lit(b).cast(dtype) for b in bounds]).cast(T.ArrayType(dtype))
    return F.coalesce(F.aggregate(values, F.lit(0), lambda n, b: n + (b <= F.col(key)).cast("int")), F.lit(0))


def is_ordered(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType))


def differing_buckets(old: DataFrame, new: DataFrame, bucket: Column, columns: Sequence[str]) -> list[int]:
    """Buckets whose digests differ, or that one state lacks: at most one number a bucket reaches the driver."""
    a = bucket_digests(old, bucket, columns).select("bucket", F.struct("n", "digest").alias("old"))
    b = bucket_digests(new, bucket, columns).select("bucket", F.struct("n", "digest").alias("new"))
    differ = a.join(b, "bucket", "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))
    return sorted(r[0] for r in differ.select("bucket").collect())


def in_ranges(key: str, dtype: T.DataType, bounds: Sequence, chosen: Sequence[int]) -> Column:
    """Condition on the key for the chosen ranges; ranges that meet are one comparison."""
    runs: list[list[int]] = []
    for b in chosen:
        if runs and runs[-1][1] == b - 1:
            runs[-1][1] = b
        else:
            runs.append([b, b])
    conditions = []
    for first, last in runs:
        sides = [F.col(key) >= F.lit(bounds[first - 1]).cast(dtype)] if first > 0 else []
        sides += [F.col(key) < F.lit(bounds[last]).cast(dtype)] if last < len(bounds) else []
        inside = reduce(lambda x, y: x & y, sides) if sides else F.lit(True)
        conditions.append(inside | F.col(key).isNull() if first == 0 and sides else inside)
    return reduce(lambda x, y: x | y, conditions, F.lit(False)) if conditions else F.lit(False)


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Rows of both states in the buckets that differ."""
    columns = new.columns
    old = old.select(*columns)
    dtype = new.schema[keys[0]].dataType
    if is_ordered(dtype):
        bounds = key_bounds(new, keys[0], buckets)
        chosen = differing_buckets(old, new, range_bucket(keys[0], bounds, dtype), columns)
        condition = in_ranges(keys[0], dtype, bounds, chosen)
    else:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        chosen = differing_buckets(old, new, bucket, columns)
        condition = bucket.isin(chosen) if chosen else F.lit(False)
    return old.where(condition), new.where(condition)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``change`` (insert, update, delete) and the columns of ``new``; a delete has only its keys.

    Keys must be distinct and not null in each state. Columns that only ``old`` has are not compared.
    """
    keys, columns = list(keys), new.columns
    before, after = changed_rows(old, new, keys, buckets)
    a = before.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*row_digest(columns)).alias("__old"))
    b = after.select("*", F.struct(*row_digest(columns)).alias("__new"))
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    both = a.join(b, on, "full_outer")
    change = (F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(F.col("__old") != F.col("__new"), "update"))
    values = [F.when(F.col("__new").isNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in keys else c for c in columns]
    return both.withColumn("change", change).where("change is not null").select("change", *values)


def apply_diff(target: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after its changes: rows of changed keys go, inserted and updated ones come."""
    kept = target.join(diff.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(diff.where("change <> 'delete'").drop("change"), allowMissingColumns=True)
