"""A landing table partitioned by day: extraction reads only the days that it needs.

Rows are stored under the day of their tracking column. A day that is written again replaces
that day (dynamic partition overwrite) and leaves the others, so a replayed load is the same
load. Extraction turns its window into conditions on the day as well as on the timestamp;
where the window comes from a table of watermarks, the days are pruned at run time (dynamic
partition pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"
#: Rows of a written file, at most.
FILE_ROWS = 1_000_000


def write_days(rows: DataFrame, path: str, track_col: str) -> None:
    """Every day in ``rows`` replaces the stored one; rows without a time are under the null day."""
    keyed = rows.withColumn(DAY, F.to_date(track_col))
    # a day is spread over as many tasks as the shuffle has, not packed into one
    spread = keyed.repartition(DAY, F.pmod(F.xxhash64(*rows.columns), F.lit(16)))
    (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS).partitionBy(DAY).parquet(path))


def extract_days(spark: SparkSession, path: str, track_col: str, low=None, high=None) -> DataFrame:
    """Rows with ``track_col`` in ``[low, high)``; only the days in between are listed and read."""
    rows = spark.read.parquet(path)
    kind = rows.schema[track_col].dataType
    if low is not None:
        at = F.lit(low).cast(kind)
        rows = rows.where((F.col(track_col) >= at) & (F.col(DAY) >= F.to_date(at)))
    if high is not None:
        at = F.lit(high).cast(kind)
        rows = rows.where((F.col(track_col) < at) & (F.col(DAY) <= F.to_date(at)))
    return rows.drop(DAY)


#: Days that one extraction by a table of days may name; more are an error.
MAX_DAYS = 100_000


def extract_since(spark: SparkSession, path: str, track_col: str, pending: DataFrame) -> DataFrame:
    """Rows of the days that ``pending`` (``day, since``: a row a day) names, from ``since`` on: the days
    are known only when it is computed, and prune the scan then."""
    if pending.limit(MAX_DAYS + 1).count() > MAX_DAYS:
        raise ValueError(f"more than {MAX_DAYS} days")
    rows = spark.read.parquet(path)
    return rows.join(F.broadcast(pending.select(DAY, "since")), DAY).where(F.col(track_col) >= F.col("since")).drop("since", DAY)
