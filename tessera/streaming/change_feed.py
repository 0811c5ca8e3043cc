"""A change feed as a stream in event time: repeats go, late rows are counted.

Feeds deliver a change at least once, and out of order. ``withWatermark`` states how late
a row may come, ``dropDuplicatesWithinWatermark`` keeps one row per key that arrives within that
time, and its state is bounded by the delay, not by the feed. A row later than the
watermark is not taken; how many there were is in the progress of every batch. They are the
part that the lookback of the next batch extraction, or a snapshot difference, repairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class FeedResult:
    """What a run of the feed did."""

    rows_in: int
    rows_late: int
    batches: int


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """One row per key among those that arrive within ``delay`` of each other, in event time."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_feed(spark: SparkSession, source_dir: str, schema: T.StructType, target_dir: str, checkpoint: str, keys: Sequence[str],
             event_time: str, delay: str, files_per_batch: int = 1) -> FeedResult:
    """Take all files of the feed that are new, oldest first, and append each change once to ``target_dir``.

    ``event_time`` must be a timestamp column of ``schema``. The checkpoint keeps watermark,
    state and progress, so a later run goes on where this one ended.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    query = (deduplicated(stream, keys, event_time, delay).writeStream.format("parquet").option("path", target_dir)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"] or p["stateOperators"]]
    late = sum(int(s["numRowsDroppedByWatermark"]) for p in progress for s in p["stateOperators"])
    return FeedResult(sum(int(p["numInputRows"]) for p in progress), late, len(progress))


def event_time_column(rows: DataFrame, column: str) -> DataFrame:
    """The column as a timestamp with the session's zone, as watermarks need it."""
    return rows.withColumn(column, F.col(column).cast("timestamp"))
