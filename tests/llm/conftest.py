import pytest
from odd_cases import CLASHES, DOC, odd_rows
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), DOC)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)
