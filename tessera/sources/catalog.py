"""Catalog listing: tables, row counts, sizes, column descriptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import load_table


def row_audit(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """(table_name, n_rows) per table plus a TOTAL row.

    Every count is a distributed aggregate; the union of one-row frames is
    totalled with ``rollup`` so no numbers pass through the driver.
    """
    parts = [load_table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in tables]
    u = reduce(DataFrame.unionByName, parts)
    r = u.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"))
    return r.select(F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "n_rows")


def list_tables(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    """(table_name, n_rows, size_bytes) sorted by rows descending.

    Sizes come from the file listing (``input_file_name`` is not needed: the
    Hadoop filesystem reports lengths without reading data).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    sizes = []
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        sizes.append((t, int(fs.getContentSummary(path).getLength())))
    size_df = spark.createDataFrame(sizes, "table_name string, size_bytes long")
    counts = row_audit(spark, sf_dir, tables).where(F.col("table_name") != "TOTAL")
    return counts.join(size_df, "table_name").orderBy(F.col("n_rows").desc(), "table_name")


def describe(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type, nullable) from the schema."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("column_name", T.StringType()),
                           T.StructField("data_type", T.StringType()), T.StructField("nullable", T.BooleanType())])
    return df.sparkSession.createDataFrame(rows, schema)
