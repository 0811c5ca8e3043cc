"""Result sinks and the prediction cache.

Sinks keyed by a run or a generator are partition folders with dynamic overwrite:
writing a key again replaces its rows and leaves the others. The cache is a keyed
versioned table, so only inputs without a prediction are computed, and a rerun
after a crash computes what is still missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sync import upsert_versioned
from tessera.operators.udf import Model, generate
from tessera.operators.versioned import VersionedTable
from tessera.session import cut_lineage


#: Tasks that write the rows of one key, at most.
TASKS_PER_KEY = 64


def replace_partitions(df: DataFrame, path: str, key: str) -> None:
    """Rows of every ``key`` value in ``df`` replace the stored ones of that value; a value is written by many tasks."""
    (df.repartition(key, F.pmod(F.xxhash64(*df.columns), F.lit(TASKS_PER_KEY))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path))


def append_run_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Metrics of a run next to those of other runs; the same run again replaces its own."""
    replace_partitions(metrics.withColumn("run_id", F.lit(run_id)), path, "run_id")


def replace_generator_results(results: DataFrame, path: str) -> None:
    """Results of the generators in ``results`` replace theirs; other generators keep their rows."""
    replace_partitions(results, path, "generator")


class PredictionCache:
    """Predictions by id for one generator, with its failures to the side."""

    def __init__(self, spark: SparkSession, root: str, generator: str):
        self.generator = generator
        self.done = VersionedTable(spark, f"{root}/{generator}/predictions", ["id"])
        self.failed = VersionedTable(spark, f"{root}/{generator}/failures", ["id"])

    def predict(self, inputs: DataFrame, model: Model, run_id: str, id_col: str = "id", input_col: str = "input") -> DataFrame:
        """Predictions of all inputs: cached ids are read, the rest are generated once and stored."""
        wanted = inputs.select(F.col(id_col).alias("id"), F.col(input_col).alias("input"))
        cached = self.done.read()
        new = wanted if cached is None else wanted.join(cached.select("id"), "id", "left_anti")
        made = cut_lineage(generate(new, "input", model))  # two tables are written from it
        run = F.lit(run_id).alias("run_id")
        upsert_versioned(self.done, made.where("error IS NULL").select("id", "prediction", run))
        upsert_versioned(self.failed, made.where("error IS NOT NULL").select("id", "error", run))
        return self.done.read().join(wanted.select("id"), "id", "left_semi")
