import io
import time
from contextlib import redirect_stdout
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tessera.operators import landing as L
from tessera.operators import snapshot_diff as D
from tessera.operators import sync as Y
from tessera.streaming import change_feed as C


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def states(spark, kind="long"):
    rows = [(i, f"v{i}", None if i % 4 == 0 else i * 1.5) for i in range(1000)]
    old = spark.createDataFrame(rows, "k long, s string, x double")
    new = old.where("k <> 700 and k <> 0").withColumn("x", F.when(F.col("k") == 704, 1.0).when(F.col("k") == 705, F.lit(None)).otherwise(F.col("x")))
    new = new.unionByName(spark.createDataFrame([(2000, "new", 1.0)], new.schema))
    return old.withColumn("k", F.col("k").cast(kind)), new.withColumn("k", F.col("k").cast(kind))


@pytest.mark.parametrize("kind", ["long", "int", "string"])
def test_differences_and_their_application(spark, kind):
    old, new = states(spark, kind)
    diff = D.snapshot_diff(old, new, ["k"], 32)
    found = {(int(r.k), r.change) for r in diff.collect()}
    assert found == {(0, "delete"), (700, "delete"), (704, "update"), (705, "update"), (2000, "insert")}
    applied = D.apply_diff(old, diff, ["k"])
    assert applied.exceptAll(new).isEmpty() and new.exceptAll(applied).isEmpty()
    assert D.snapshot_diff(new, new, ["k"]).isEmpty()


def test_only_ranges_that_differ_are_read(spark, tmp_path):
    old, new = states(spark)
    for name, df in (("old", old), ("new", new)):
        df.repartitionByRange(8, "k").write.parquet(f"{tmp_path}/{name}")
    old, new = spark.read.parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new")
    before, after = D.changed_rows(old, new, ["k"], 32)
    assert before.count() < 200 and after.count() < 200
    assert "PushedFilters: [Or(" in plan_of(before).replace("\n", "")


def test_empty_states(spark):
    old, new = states(spark)
    none = new.limit(0)
    assert D.snapshot_diff(none, new, ["k"]).where("change = 'insert'").count() == new.count()
    assert D.snapshot_diff(old, none, ["k"]).where("change = 'delete'").count() == old.count()
    assert D.snapshot_diff(none, none, ["k"]).isEmpty()


def test_swapped_values_are_seen(spark):
    """Sums of digests do not cancel when values move between columns, rows or nulls."""
    old = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "x", "y")], "k long, a string, b string")
    new = spark.createDataFrame([(1, None, "a"), (2, "a", None), (3, "x", "y")], "k long, a string, b string")
    assert {r.k for r in D.snapshot_diff(old, new, ["k"], 1).collect()} == {1, 2}


# --- landing

def landed(spark, path):
    start = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(i, start + timedelta(hours=6 * i)) for i in range(40)], "id long, ts timestamp_ntz")
    L.write_days(rows, path, "ts")
    return rows


def test_window_reads_its_days_only(spark, tmp_path):
    rows = landed(spark, str(tmp_path))
    found = L.extract_days(spark, str(tmp_path), "ts", "2024-01-03 06:00:00", "2024-01-05 00:00:00")
    assert {r.id for r in found.collect()} == {r.id for r in rows.where("ts >= '2024-01-03 06:00:00' and ts < '2024-01-05'").collect()}
    plan = plan_of(found).replace("\n", "")
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2024-01-03" in filters and "<= 2024-01-05" in filters


def test_a_day_written_again_replaces_that_day(spark, tmp_path):
    rows = landed(spark, str(tmp_path))
    again = rows.where(F.to_date("ts") == "2024-01-02").withColumn("id", F.col("id") + 100)
    for _ in range(2):
        L.write_days(again, str(tmp_path), "ts")
    found = sorted(r.id for r in L.extract_days(spark, str(tmp_path), "ts").collect())
    assert found == sorted([i for i in range(40) if not 4 <= i < 8] + [104, 105, 106, 107])


def test_days_from_a_table_prune_at_run_time(spark, tmp_path):
    rows = landed(spark, str(tmp_path))
    pending = spark.createDataFrame([(date(2024, 1, 2), datetime(2024, 1, 2, 7)), (date(2024, 1, 9), datetime(2024, 1, 9))], "day date, since timestamp_ntz")
    pending.write.parquet(f"{tmp_path}-pending")
    pending = spark.read.parquet(f"{tmp_path}-pending").where("since > timestamp_ntz '2023-01-01 00:00:00'")
    found = L.extract_since(spark, str(tmp_path), "ts", pending)
    assert "dynamicpruning" in plan_of(found)
    assert {r.id for r in found.collect()} == {r.id for r in rows.where("(ts >= '2024-01-02 07:00:00' and ts < '2024-01-03') or (ts >= '2024-01-09' and ts < '2024-01-10')").collect()}


# --- change feed

def test_rows_later_than_the_watermark_are_counted(spark, tmp_path):
    schema = "id long, ts timestamp, v string"

    def send(*rows):
        df = spark.createDataFrame([(i, datetime.fromisoformat(t), v) for i, t, v in rows], schema).coalesce(1)
        df.write.mode("append").parquet(f"{tmp_path}/feed")
        return C.run_feed(spark, f"{tmp_path}/feed", df.schema, f"{tmp_path}/out", f"{tmp_path}/ck", ["id"], "ts", "1 hour")
    first = send((1, "2024-01-01 10:00:00", "a"), (1, "2024-01-01 10:00:00", "a"), (2, "2024-01-01 12:00:00", "b"))
    assert (first.rows_in, first.rows_late) == (3, 0)
    second = send((2, "2024-01-01 12:00:00", "b"), (3, "2024-01-01 11:30:00", "in time"), (4, "2024-01-01 09:00:00", "late"))
    assert second.rows_late == 1
    assert sorted((r.id, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "a"), (2, "b"), (3, "in time")]


# --- many tables at once

def test_a_hanging_table_is_cancelled_alone(spark, tmp_path):
    rows = spark.createDataFrame([(1, datetime(2024, 1, 15), "x")], "id long, ts timestamp_ntz, v string")

    @F.udf("string")
    def hang(v):
        time.sleep(120)
        return v
    specs = [Y.TableSpec("slow", lambda: rows.withColumn("v", hang("v")), ["id"], "ts")]
    specs += [Y.TableSpec(f"t{i}", lambda: rows, ["id"], "ts") for i in range(3)]
    begun = time.monotonic()
    results = Y.run_sync(spark, specs, str(tmp_path), "2024-01-20 00:00:00", "r1", workers=4, timeout_s=25)
    assert time.monotonic() - begun < 90
    assert [(r["table"], r["status"]) for r in results] == [("slow", "failed"), ("t0", "ok"), ("t1", "ok"), ("t2", "ok")]
    assert "timed out" in results[0]["message"]
    store = Y.WatermarkStore(spark, f"{tmp_path}/_watermarks")
    assert store.get("slow") is None and all(store.get(f"t{i}") is not None for i in range(3))


def test_tables_run_side_by_side(spark):
    def wait(name):
        def run():
            time.sleep(1.5)
            return {"table": name, "status": "ok", "message": None}
        return run
    begun = time.monotonic()
    results = Y.run_tables(spark, {f"t{i}": wait(f"t{i}") for i in range(6)}, 6, None)
    assert time.monotonic() - begun < 6 * 1.5 / 2 and [r["table"] for r in results] == [f"t{i}" for i in range(6)]
