"""Lines of log files with their numbers, from files that are split over tasks.

A text file has no line numbers, and a task that reads a split of it does not know how many
lines came before. So the lines of every split are counted first; sums over the splits before
it (a row per split, not per line) give each split its first number, and a line is that
number plus its place in the split. A run that writes its log in segments numbers on from
one segment to the next, in the order of their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.files import METRIC_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of all lines of a file, or of the files of a folder; numbers start at 0 and
    run on over the files by name. Any number of tasks may read one file."""
    rows = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"))
    splits = rows.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "start", (F.col("base") - F.col("first")).alias("shift"))
    return rows.join(offsets, ["file", "start"]).select("file", (F.col("place") + F.col("shift")).alias("line_no"), "line")


def metric_kind():
    """Which kind of row a line of a training log is, by the keys that it has."""
    return (F.when(F.col("train_runtime").isNotNull(), "summary").when(F.col("eval_loss").isNotNull(), "eval")
            .when(F.col("loss").isNotNull(), "train").otherwise("other"))


def parse_metrics(lines: DataFrame) -> DataFrame:
    """Metric columns and ``kind`` of lines of JSON in place of ``line``; blank lines go."""
    others = [c for c in lines.columns if c != "line"]
    parsed = lines.where(F.trim("line") != "").select(*others, F.from_json("line", METRIC_SCHEMA).alias("m"))
    return parsed.select(*others, "m.*").withColumn("kind", metric_kind())


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a run's log, numbered over its segments."""
    return parse_metrics(read_lines(spark, path))
