import json
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tessera.operators import runs as R
from tessera.operators import sync as Y
from tessera.sources.files import read_metric_log
from tessera.streaming.metric_stream import LINE_KEY, metric_stream, metric_tail
from tessera.streaming.sync_stream import sync_stream

SCHEMA = "id long, ts timestamp_ntz, v string"


def _rows(spark, rows):
    return spark.createDataFrame([(i, datetime.fromisoformat(t), v) for i, t, v in rows], SCHEMA)


def test_extract_window_and_dedupe(spark):
    df = _rows(spark, [(1, "2024-01-14 23:55:00", "at-from"), (1, "2024-01-15 01:00:00", "newer"),
                       (2, "2024-01-14 23:54:59", "before"), (3, "2024-01-20 00:00:00", "at-ceiling")])
    ch = Y.incremental_extract(df, "ts", "2024-01-15 00:00:00", "2024-01-20 00:00:00", 300)
    assert sorted(r.v for r in ch.collect()) == ["at-from", "newer"]
    d = Y.dedupe_changes(ch, ["id"], ["ts"]).collect()
    assert [(r.id, r.v) for r in d] == [(1, "newer")]


def test_upsert_idempotent_and_keeps_columns(spark):
    tgt = _rows(spark, [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:00", "b")])
    ch = _rows(spark, [(2, "2024-01-02 00:00:00", "b2"), (3, "2024-01-02 00:00:00", "c")])
    once = Y.upsert(tgt, ch, ["id"])
    twice = Y.upsert(once, ch, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {1: "a", 2: "b2", 3: "c"}
    kept = Y.upsert(tgt, ch, ["id"], keep_from_target=["ts"])
    assert {r.id: str(r.ts) for r in kept.collect()}[2] == "2024-01-01 00:00:00"


def test_failed_write_does_not_advance_watermark(spark, tmp_path):
    root = str(tmp_path)
    store = Y.WatermarkStore(spark, f"{root}/_wm")
    target = Y.VersionedTable(spark, f"{root}/t", ["id"])
    bad = _rows(spark, [(1, "2024-01-15 00:00:00", "x")]).withColumn("v", F.raise_error(F.lit("boom")))
    res = Y.sync_table(bad, target, store, "t", "ts", "2024-01-20 00:00:00", "r1")
    assert res["status"] == "failed"
    assert store.get("t") is None
    good = _rows(spark, [(1, "2024-01-15 00:00:00", "x")])
    res = Y.sync_table(good, target, store, "t", "ts", "2024-01-20 00:00:00", "r2")
    assert res["status"] == "ok" and str(store.get("t")) == "2024-01-20 00:00:00"
    assert Y.run_status([{"status": "ok"}, {"status": "failed"}]) == "partial"


def test_a_reused_run_id_still_applies_new_changes(spark, tmp_path):
    store, target = Y.WatermarkStore(spark, f"{tmp_path}/_wm"), Y.VersionedTable(spark, f"{tmp_path}/t", ["id"])
    for v, ceiling in (("a", "2024-01-10 00:00:00"), ("b", "2024-01-20 00:00:00")):
        src = _rows(spark, [(1, "2024-01-09 23:59:00", v), (2 if v == "a" else 3, "2024-01-09 23:58:00", v)])
        assert Y.sync_table(src, target, store, "t", "ts", ceiling, "same-run")["status"] == "ok"
    assert {r.id: r.v for r in target.read().collect()} == {1: "b", 2: "a", 3: "b"}


def test_write_that_stops_at_any_step_loses_nothing(spark, tmp_path, monkeypatch):
    """A crash while data is written, before, while and after it becomes current: the next upsert starts from a whole table."""
    for step in ("_write", "_commit", "append", "drop_before"):
        root = f"{tmp_path}/{step}"
        table = Y.VersionedTable(spark, root, ["id"])
        table.replace(_rows(spark, [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-01 00:00:00", "b")]))
        change = _rows(spark, [(3, "2024-01-02 00:00:00", "c")])

        def stop(*args, **kw):
            raise RuntimeError("stopped here")
        with monkeypatch.context() as m:
            m.setattr(table if step.startswith("_") else table.current, step, stop)
            try:
                Y.upsert_versioned(table, change)
                table.replace(table.read())
            except RuntimeError as e:
                assert "stopped here" in str(e)
        again = Y.VersionedTable(spark, root, ["id"])
        assert {r.id for r in again.read().collect()} >= {1, 2}
        Y.upsert_versioned(again, change)
        assert {r.id: r.v for r in again.read().collect()} == {1: "a", 2: "b", 3: "c"}


def test_data_without_a_current_table_is_an_error(spark, tmp_path):
    table = Y.VersionedTable(spark, str(tmp_path), ["id"])
    table.replace(_rows(spark, [(1, "2024-01-01 00:00:00", "a")]))
    kept = {f: f.read_bytes() for f in (tmp_path / "current").glob("*.parquet")}
    for f in kept:
        f.write_bytes(b"torn")
    for crc in (tmp_path / "current").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception):
        table.read()
    with pytest.raises(Exception):
        Y.upsert_versioned(table, _rows(spark, [(2, "2024-01-01 00:00:00", "b")]))
    for f in kept:
        f.unlink()
    with pytest.raises(RuntimeError, match="no readable table"):
        table.read()


def test_two_writers_are_an_error(spark, tmp_path):
    table = Y.VersionedTable(spark, str(tmp_path), ["id"], part_rows=2)
    table.replace(_rows(spark, [(i, "2024-01-01 00:00:00", "a") for i in range(8)]))
    state = table.current.state()
    for part in list(state.paths)[:2]:
        table.current.append(state, {part: (state.paths[part], 1)}, {part: table.schema().json()}, state.n_parts, False)
    with pytest.raises(RuntimeError, match="two writers"):
        table.read()


def test_parts_follow_the_rows_and_upserts_rewrite_touched_ones(spark, tmp_path):
    table = Y.VersionedTable(spark, str(tmp_path), ["id"], part_rows=10)
    table.replace(_rows(spark, [(i, "2024-01-01 00:00:00", "a") for i in range(200)]))
    before = table.current.state()
    assert before.n_parts == 20 and sum(before.rows.values()) == 200
    Y.upsert_versioned(table, spark.createDataFrame([(7, datetime(2024, 1, 2), "b")], "id int, ts timestamp_ntz, v string"))
    after = table.current.state()
    assert sum(before.paths[p] != after.paths[p] for p in before.paths) == 1
    assert table.read().count() == 200 and table.read().where("v = 'b'").first().id == 7
    # a table that has outgrown its parts is dealt anew
    Y.upsert_versioned(table, _rows(spark, [(i, "2024-01-01 00:00:00", "c") for i in range(200, 500)]))
    Y.upsert_versioned(table, _rows(spark, [(500, "2024-01-01 00:00:00", "c")]))
    assert table.current.state().n_parts == 51 and table.read().count() == 501


def test_the_generation_before_is_kept_and_older_ones_go(spark, tmp_path):
    table = Y.VersionedTable(spark, str(tmp_path), ["id"])
    for k in range(4):
        held = table.read()  # a reader of the generation before
        table.replace(_rows(spark, [(i, "2024-01-01 00:00:00", "a") for i in range(k + 1)]))
        assert held is None or held.count() == k
    assert len(list((tmp_path / "data").iterdir())) == 2


def test_a_table_without_rows(spark, tmp_path):
    table = Y.VersionedTable(spark, str(tmp_path), ["id"])
    Y.upsert_versioned(table, _rows(spark, []))
    assert table.read().count() == 0 and table.schema().fieldNames() == ["id", "ts", "v"]
    Y.upsert_versioned(table, _rows(spark, [(1, "2024-01-01 00:00:00", "a")]))
    assert [r.v for r in table.read().collect()] == ["a"]


def test_snapshot_swaps_all_tables_and_carries_derived_ones(spark, tmp_path):
    snap = Y.Snapshot(spark, str(tmp_path))
    snap.publish({"a": spark.range(3), "derived": spark.range(9)})
    snap.publish({"a": spark.range(5)}, carry=["derived"])
    assert (snap.read("a").count(), snap.read("derived").count()) == (5, 9)
    with pytest.raises(ValueError):
        snap.publish({"a": spark.range(1)}, carry=["never there"])
    bad = spark.range(1).select(F.raise_error(F.lit("boom")).alias("x"))
    with pytest.raises(Exception, match="boom"):
        snap.publish({"a": spark.range(7), "b": bad})
    assert snap.read("a").count() == 5


def test_run_over_many_tables_is_partial_and_logged(spark, tmp_path):
    log = Y.RunLog(spark, f"{tmp_path}/runs")
    rows = _rows(spark, [(1, "2024-01-15 00:00:00", "x")])

    def gone():
        raise OSError("cannot open")
    specs = [Y.TableSpec("a", lambda: rows, ["id"], "ts"), Y.TableSpec("b", gone, ["id"], "ts")]
    for k in range(2):
        results = Y.run_sync(spark, specs, str(tmp_path), "2024-01-20 00:00:00", "r1", log)
        assert [r["status"] for r in results] == ["ok", "failed"] and (results[0]["bytes"] > 0) == (k == 0)
        assert k == 1 or log.read().first().dump_bytes == results[0]["bytes"]
    found = log.read().collect()
    assert len(found) == 1 and found[0].status == "partial" and "cannot open" in found[0].message and found[0].dump_bytes == 0  # the run again had nothing to write


def test_stream_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="tessera-stream-")
    rows = [(i % 7, f"2024-01-{1 + i % 20:02d} 00:00:{i % 60:02d}", f"v{i}") for i in range(200)]
    df = _rows(spark, rows)
    df.repartition(5).write.parquet(f"{root}/in")
    target = Y.VersionedTable(spark, f"{root}/t", ["id"])
    out = sync_stream(spark, f"{root}/in", df.schema, target, ["ts", "v"], f"{root}/ck")
    batch = Y.dedupe_changes(df, ["id"], ["ts", "v"])
    assert sorted(out.select("id", "ts", "v").collect()) == sorted(batch.select("id", "ts", "v").collect())
    # a second availableNow run with no new files changes nothing
    again = sync_stream(spark, f"{root}/in", df.schema, target, ["ts", "v"], f"{root}/ck")
    assert sorted(again.collect()) == sorted(out.collect())
    # another feed with batch ids of its own starts at 0 again: nothing of it is taken for a replay
    more = _rows(spark, [(50, "2024-02-01 00:00:00", "new"), (1, "2023-01-01 00:00:00", "old")])
    more.write.parquet(f"{root}/in2")
    both = {r.id: r.v for r in sync_stream(spark, f"{root}/in2", df.schema, target, ["ts", "v"], f"{root}/ck2").collect()}
    assert both[50] == "new" and both[1] != "old"


def _write_log(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


LOG_A = [{"step": 10, "epoch": 0.1, "loss": 2.9}, {"step": 50, "epoch": 0.5, "eval_loss": 0.87, "eval_mean_token_accuracy": 0.80},
         {"step": 100, "epoch": 1.0, "eval_loss": 0.5183, "eval_mean_token_accuracy": 0.87},
         {"step": 100, "epoch": 1.0, "eval_loss": 0.5131, "eval_mean_token_accuracy": 0.8751},
         {"step": 120, "epoch": 1.2, "train_runtime": 900.0, "train_loss": 0.70},
         {"step": 120, "epoch": 1.2, "train_runtime": 1232.4, "train_loss": 0.6828}]
LOG_B = [{"step": 50, "epoch": 0.5, "eval_loss": 0.86, "eval_mean_token_accuracy": 0.81},
         {"step": 150, "epoch": 1.5, "eval_loss": 0.39, "eval_mean_token_accuracy": 0.90},
         {"step": 150, "epoch": 1.5, "train_runtime": 766.3, "train_loss": 0.68}]


def test_compare_runs_last_line_wins(spark):
    d = tempfile.mkdtemp(prefix="tessera-logs-")
    _write_log(f"{d}/a.jsonl", LOG_A)
    _write_log(f"{d}/b.jsonl", LOG_B)
    a, b = read_metric_log(spark, f"{d}/a.jsonl"), read_metric_log(spark, f"{d}/b.jsonl")
    cmp = {r.step: r for r in R.compare_eval(a, b).collect()}
    assert cmp[100].eval_loss_a == 0.5131 and cmp[100].eval_loss_b is None
    assert cmp[150].eval_loss_a is None and cmp[150].eval_loss_b == 0.39
    s = {r.metric: r.value_a for r in R.compare_summary(a, b).collect()}
    assert s["train_runtime"] == 1232.4
    table = R.render_eval_table(R.compare_eval(a, b))
    assert "| 100 | 0.5131 | - |" in table
    assert R.final_eval(a).first().step == 100


def test_final_eval_is_the_last_line_not_the_largest_step(spark, tmp_path):
    _write_log(f"{tmp_path}/c.jsonl", [{"step": 200, "eval_loss": 0.5}, {"step": 50, "eval_loss": 0.4}])
    assert R.final_eval(read_metric_log(spark, f"{tmp_path}/c.jsonl")).first().step == 50


def test_metric_stream_and_tail(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    _write_log(f"{logs}/a.jsonl", LOG_A + [{"step": 10, "loss": 2.5}])
    target = Y.VersionedTable(spark, f"{tmp_path}/out", LINE_KEY)
    out = metric_stream(spark, str(logs), target, f"{tmp_path}/ck")
    ev = {r.step: r.eval_loss for r in R.last_by_step(out, "eval", ["eval_loss"]).collect()}
    assert ev == {50: 0.87, 100: 0.5131}
    assert sorted(r.loss for r in out.where("kind = 'train'").collect()) == [2.5, 2.9]  # both rows of step 10
    with open(f"{logs}/a.jsonl", "a", encoding="utf-8") as f:
        f.write(json.dumps({"step": 130, "eval_loss": 0.3}) + "\n" + '{"step": 14')
    out = metric_tail(spark, str(logs), target)
    assert out.count() == len(LOG_A) + 2 and R.final_eval(out).first().step == 130
    with open(f"{logs}/a.jsonl", "a", encoding="utf-8") as f:
        f.write('0, "eval_loss": 0.2}\n')
    assert R.final_eval(metric_tail(spark, str(logs), target)).first().step == 140


def test_two_models_in_one_worker(spark):
    from tessera.operators.udf import Model, _model

    def maker(n):
        return Model("times", str(n), lambda: lambda xs: [n * len(x) for x in xs])
    assert [_model(maker(n))(["ab"])[0] for n in range(50)] == [2 * n for n in range(50)]


def test_cache_computes_what_is_missing(spark, tmp_path):
    from tessera.operators.sinks import PredictionCache
    from tessera.operators.udf import Model

    def load():
        def fn(xs):
            if any(x == "bad" for x in xs):
                raise ValueError("bad input")
            return [x + "!" for x in xs]
        return fn
    cache = PredictionCache(spark, str(tmp_path), "g")
    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "id long, input string")
    cache.predict(df.where("id < 3"), Model("m", "1", load), "r1")
    out = {r.id: (r.prediction, r.run_id) for r in cache.predict(df, Model("m", "1", load), "r2").collect()}
    assert out == {1: ("a!", "r1"), 3: ("c!", "r2")}
    assert [(r.id, r.error, r.run_id) for r in cache.failed.read().collect()] == [(2, "bad input", "r2")]


def test_examples_with_a_torn_line(spark, tmp_path):
    from tessera.sources.files import read_examples_jsonl, read_examples_with_rejects
    lines = ['{"id": "1", "output": "x", "input": {"name": "n"}}', "", '{"id": "2", "output": "y', '{"id": null, "output": "z"}']
    (tmp_path / "e.jsonl").write_text("\n".join(lines))
    with pytest.raises(Exception):
        read_examples_jsonl(spark, str(tmp_path)).collect()
    good, bad = read_examples_with_rejects(spark, str(tmp_path))
    assert sorted((r.id or "", r.output) for r in good.collect()) == [("", "z"), ("1", "x")]
    assert [r.line for r in bad.collect()] == [lines[2]]


def test_deletes_reach_the_replica(spark, tmp_path):
    source = _rows(spark, [(i, "2024-01-01 00:00:00", f"v{i}") for i in range(200)])
    table = Y.VersionedTable(spark, str(tmp_path), ["id"], part_rows=10)
    assert Y.repair_from_source(table, source) == {"insert": 200}
    before = table.current.state().paths
    later = source.where("id not in (3, 4)").withColumn("v", F.when(F.col("id") == 7, "changed").otherwise(F.col("v")))
    later = later.unionByName(_rows(spark, [(900, "2024-01-01 00:00:00", "new")]))
    # the tracking column tells an incremental run nothing of these
    assert Y.incremental_extract(later, "ts", "2024-01-15 00:00:00", "2024-01-20 00:00:00").isEmpty()
    assert Y.repair_from_source(table, later.select("v", "id", "ts", F.lit(1).alias("more"))) == {"delete": 2, "update": 1, "insert": 1}
    assert table.read().exceptAll(later).isEmpty() and later.exceptAll(table.read()).isEmpty()
    after = table.current.state().paths
    assert sum(before[p] != after.get(p) for p in before) <= 4
    assert Y.repair_from_source(table, later) == {}


def test_large_part_is_written_by_many_tasks(spark, tmp_path):
    """Long texts: the rows of one part do not meet in one task."""
    import glob
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(100)), lambda k: F.md5(F.concat(F.col("id").cast("string"), k.cast("string")))), "")
        table = Y.VersionedTable(spark, str(tmp_path), ["id"])
        Y.upsert_versioned(table, spark.range(0, 1000, 1, 8).select("id", text.alias("text")))
        Y.upsert_versioned(table, spark.range(500, 1500, 1, 8).select("id", text.alias("text")))
    finally:
        spark.conf.set(key, before)
    assert table.read().agg(F.count(F.lit(1)), F.count_distinct("id")).first()[:] == (1500, 1500)
    assert table.current.state().n_parts == 1
    assert len({f for f in glob.glob(f"{tmp_path}/data/*/part=0/*.parquet")}) > 2
    newest = next(iter(table.current.state().paths.values()))
    assert len(glob.glob(f"{tmp_path}/{newest}/*.parquet")) > 1
