import math
from datetime import datetime

from pyspark.sql import functions as F

from tessera.functions import numeric as NUM
from tessera.sources.sql import run_sql


def _py_softmax(xs):
    m = max(xs)
    e = [math.exp(x - m) for x in xs]
    s = sum(e)
    return [x / s for x in e]


def test_softmax_and_cross_entropy(spark):
    rows = [([1.0, 2.0, 3.0], 2), ([1000.0, 1000.0, -1000.0], 0), ([-5.0, 0.5], 1)]
    df = spark.createDataFrame(rows, "logits array<double>, target int")
    got = df.select(NUM.softmax(F.col("logits")).alias("p"),
                    NUM.cross_entropy(F.col("logits"), F.col("target")).alias("ce")).collect()
    for (logits, target), r in zip(rows, got):
        want = _py_softmax(logits)
        assert all(abs(a - b) < 1e-12 for a, b in zip(r.p, want))
        assert abs(r.ce - (-math.log(want[target]))) < 1e-9  # finite even for +-1000 logits


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 7, 179575),), (datetime(1969, 12, 31, 23, 59, 59, 500000),)],
                               "ts timestamp_ntz")
    r = df.select(NUM.epoch_seconds(F.col("ts")).alias("e")) \
          .select("e", NUM.epoch_to_utc_text(F.col("e")).alias("s")) \
          .select("e", "s", NUM.utc_text_to_timestamp(F.col("s")).alias("back")).collect()
    assert [x.e for x in r] == [1704067207, -1]  # floor, also before 1970
    assert [x.s for x in r] == ["2024-01-01T00:00:07Z", "1969-12-31T23:59:59Z"]
    assert r[0].back == datetime(2024, 1, 1, 0, 0, 7)


def test_run_sql_binds_named_markers(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "k long, tag string")
    out = run_sql(spark, "SELECT count(*) AS n FROM t_params WHERE tag = :tag AND k >= :lo",
                  {"tag": "a", "lo": 2}, views={"t_params": df})
    assert out.first().n == 1
