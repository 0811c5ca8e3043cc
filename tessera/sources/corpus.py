"""Text corpora assembled from several tables.

``load_sources`` turns ``(source, table, column)`` specs into one
``(source, row_id, text)`` frame, blank and NULL texts dropped, by a union
of projections: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import Tables

# (source tag, table, id column, text column) of the language-model corpus.
DEFAULT_SOURCES = (
    ("documents", "documents", "doc_id", "text"),
    ("part", "part", "p_partkey", "p_name"),
    ("benchmark", "benchmark", "item_id", "text"),
)


def load_sources(spark: SparkSession, sf_dir: str, specs=DEFAULT_SOURCES) -> DataFrame:
    frames = []
    for tag, table, id_col, col in specs:
        df = Tables(spark, sf_dir).spread(table)
        frames.append(df.where(F.col(col).isNotNull() & (F.col(col) != ""))
                        .select(F.lit(tag).alias("source"), F.col(id_col).cast("long").alias("row_id"),
                                F.col(col).alias("text")))
    return reduce(DataFrame.unionByName, frames)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited text file -> (line) rows."""
    return spark.read.text(path).withColumnRenamed("value", "line")
