"""Parametrised SQL over registered views.

Named markers (``:name``) are bound by Spark itself (``spark.sql(sql,
args=...)``), so values never get spliced into the SQL text and Catalyst
still sees literals it can push into the scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None,
            views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=dict(params or {}))
