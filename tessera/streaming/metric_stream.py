"""Metric logs into a table, from files that arrive and from files that grow.

Rows are keyed by file and line number, so both ways are idempotent and nothing is
deduplicated on the way: a step that occurs twice keeps both rows, and readers
take the last line of a step where they want one (``operators.runs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sync import VersionedTable, upsert_versioned
from tessera.sources.files import METRIC_SCHEMA, metric_rows, read_metric_log

LINE_KEY = ("file", "line_no")


def metric_stream(spark: SparkSession, log_dir: str, target: VersionedTable, checkpoint: str) -> DataFrame:
    """New log files, each read whole (``wholetext``, so line numbers are exact), as a stream that
    takes what is there and ends. A file source reads a file once: for logs that grow see ``metric_tail``."""
    parsed = metric_rows(spark.readStream.format("text").option("wholetext", "true").load(log_dir))
    q = (parsed.writeStream.foreachBatch(lambda batch, _: upsert_versioned(target, batch))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return target.read()


def metric_tail(spark: SparkSession, log_dir: str, target: VersionedTable) -> DataFrame:
    """Lines that the target does not have yet, from all files of the folder: run again and again,
    it follows logs that are appended to. The last line of a file is taken when its line end is there."""
    rows = read_metric_log(spark, log_dir, whole_lines=True)
    seen = target.read()
    if seen is not None:
        last = seen.groupBy("file").agg(F.max("line_no").alias("_last"))
        rows = rows.join(last, "file", "left").where("_last IS NULL OR line_no > _last").drop("_last")
    upsert_versioned(target, rows)
    return target.read()


__all__ = ["LINE_KEY", "METRIC_SCHEMA", "metric_stream", "metric_tail"]
