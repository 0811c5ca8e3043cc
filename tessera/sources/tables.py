"""Parquet table sources.

Tables are plain Parquet directories/files; reading through
``spark.read.parquet`` keeps predicate pushdown and column pruning in
Catalyst's hands (``PushedFilters`` / ``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame, path: str) -> DataFrame:
    """Deal the rows of a small input over the cluster's cores before heavy work on each row.

    Input below one read split per core may come in fewer splits than cores (a file
    with one row group is one split). Its size is read from the file listing; what
    the exchange moves is bounded by a split per core, and larger input is untouched.
    """
    spark = df.sparkSession
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size < cores * split else df


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.documents``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def spread(self, name: str) -> DataFrame:
        """A table for heavy work per row: see ``spread``."""
        return spread(load_table(self.spark, self.sf_dir, name), table_path(self.sf_dir, name))
