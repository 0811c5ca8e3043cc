"""Incremental and full table replication on Parquet directories.

Semantics (batch and streaming share them):

* extract: rows whose tracking column is in ``[watermark - lookback, ceiling)``;
  no watermark means a full copy up to the ceiling;
* dedupe: the lookback overlap must be idempotent, so changes collapse to the
  last version per key (``max_by`` over a total order; its struct buffer makes
  this a sort-based aggregate);
* upsert: ``target LEFT ANTI changes  UNION ALL  changes``, in the parts of the
  table that hold changed keys (see ``versioned``: new folders, then a row of what is current);
* the watermark and the run log are tiny state tables committed *after* the
  data write succeeded, so a failed write never advances the watermark.

Every merge is idempotent, so a replayed run or batch is simply merged again.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.snapshot_diff import apply_diff, snapshot_diff
from tessera.operators.versioned import Snapshot, VersionedTable
from tessera.session import cut_lineage

DEFAULT_LOOKBACK_S = 300


# ---------------------------------------------------------------- pure plans
def incremental_extract(src: DataFrame, track_col: str, watermark=None, ceiling=None,
                        lookback_s: int = DEFAULT_LOOKBACK_S) -> DataFrame:
    """Rows with ``track_col`` in ``[watermark - lookback, ceiling)`` (pushed to the scan)."""
    cond = F.lit(True)
    ts_type = dict(src.dtypes)[track_col]
    if watermark is not None:
        lo = F.lit(watermark).cast(ts_type) - F.expr(f"INTERVAL {int(lookback_s)} SECONDS")
        cond = cond & (F.col(track_col) >= lo)
    if ceiling is not None:
        cond = cond & (F.col(track_col) < F.lit(ceiling).cast(ts_type))
    return src.where(cond)


def dedupe_changes(changes: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last version per key by ``order`` (must be a total order, e.g. (ts, id))."""
    others = [c for c in changes.columns if c not in pk]
    g = changes.groupBy(*pk).agg(
        F.max_by(F.struct(*[F.col(c) for c in others]), F.struct(*[F.col(c) for c in order])).alias("_v"))
    return g.select(*pk, *[F.col("_v")[c].alias(c) for c in others])


def upsert_newest(target: DataFrame, changes: DataFrame, pk: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Order-independent upsert: per key the newest row of target and changes wins.

    Used by the streaming path, where micro-batches may arrive in any file order.
    """
    changes = align_columns(changes, target.columns)
    return dedupe_changes(target.unionByName(changes), pk, order).select(*target.columns)


def align_columns(src: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """Columns present on both sides, by name, in the target's order."""
    have = set(src.columns)
    return src.select(*[c for c in target_columns if c in have])


def upsert(target: DataFrame, changes: DataFrame, pk: Sequence[str],
           keep_from_target: Sequence[str] = ()) -> DataFrame:
    """Insert-or-replace by key. ``keep_from_target`` columns keep the old value on match."""
    changes = align_columns(changes, target.columns)
    kept = target.join(changes.select(*pk), list(pk), "left_anti")
    if keep_from_target:
        old = target.select(*pk, *[F.col(c).alias(f"_old_{c}") for c in keep_from_target])
        ch = changes.join(old, list(pk), "left")
        for c in keep_from_target:
            ch = ch.withColumn(c, F.coalesce(F.col(f"_old_{c}"), F.col(c))).drop(f"_old_{c}")
        changes = ch.select(*target.columns)
    return kept.unionByName(changes.select(*target.columns), allowMissingColumns=True)


# ---------------------------------------------------------------- versioned tables
def upsert_versioned(table: VersionedTable, changes: DataFrame, keep_from_target: Sequence[str] = ()) -> DataFrame:
    """Insert-or-replace by the table's key, in the parts that hold changed keys.

    Running it again with the same changes gives the same table.
    """
    def combine(old, new):
        return new if old is None else upsert(old, new, table.pk, keep_from_target)
    return table.merge(changes, combine)


def upsert_newest_versioned(table: VersionedTable, changes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Newest row per key wins, whatever the order or repetition of the change sets."""
    def combine(old, new):
        return dedupe_changes(new, table.pk, order) if old is None else upsert_newest(old, new, table.pk, order)
    return table.merge(changes, combine)


def repair_from_source(table: VersionedTable, src: DataFrame) -> dict[str, int]:
    """Make the table equal to its source, deletes included, and return the number of changes by kind.

    An incremental run never learns of deleted rows, nor of changes that did not move the tracking
    column. The difference of both states is found by digests of key ranges and applied to the parts
    that hold changed keys; columns that the table does not know are not compared.
    """
    target = table.read()
    if target is None:
        table.replace(src)
        return {"insert": src.count()}
    wanted = src.select(*[F.col(f.name).cast(f.dataType) for f in target.schema])
    diff = cut_lineage(snapshot_diff(target, wanted, table.pk))
    table.merge(diff.select(*table.pk), lambda old, _: apply_diff(old, diff, table.pk))
    return {r["change"]: r["count"] for r in diff.groupBy("change").count().collect()}


# ---------------------------------------------------------------- state tables
STATE_SCHEMA = T.StructType([T.StructField("table_name", T.StringType()),
                             T.StructField("watermark", T.TimestampNTZType()),
                             T.StructField("run_id", T.StringType())])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("duration_seconds", T.DoubleType()), T.StructField("row_count", T.LongType()),
    T.StructField("dump_bytes", T.LongType()), T.StructField("message", T.StringType()),
    T.StructField("recorded_at", T.TimestampNTZType())])


class WatermarkStore:
    """Per-table watermark as a versioned keyed table; default = no watermark (full copy)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, root, ["table_name"])
        self.lock = threading.Lock()  # tables of a run commit one after the other

    def get(self, table_name: str):
        df = self.table.read()
        if df is None:
            return None
        r = df.where(F.col("table_name") == table_name).select("watermark").limit(1).collect()
        return r[0][0] if r else None  # one scalar of a tiny state table

    def commit(self, table_name: str, watermark, run_id: str) -> None:
        row = self.spark.createDataFrame([(table_name, _timestamp(watermark), run_id)], STATE_SCHEMA)
        with self.lock:
            upsert_versioned(self.table, row)


class RunLog:
    """One row per run, keyed by run id: recording a run again replaces its row."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, root, ["run_id"])

    def record(self, run_id: str, source: str, status: str, started_at, duration_seconds: float,
               row_count: int | None = None, dump_bytes: int | None = None, message: str | None = None,
               recorded_at=None) -> None:
        row = (run_id, source, status, _timestamp(started_at), float(duration_seconds), row_count, dump_bytes, message,
               _timestamp(recorded_at) if recorded_at else datetime.now(timezone.utc).replace(tzinfo=None))
        upsert_versioned(self.table, self.spark.createDataFrame([row], RUN_LOG_SCHEMA))

    def read(self) -> DataFrame | None:
        return self.table.read()


def _timestamp(value):
    return datetime.fromisoformat(value) if isinstance(value, str) else value


def sync_table(src: DataFrame, target: VersionedTable, store: WatermarkStore, table_name: str, track_col: str,
               ceiling, run_id: str, tiebreak: Sequence[str] = (), lookback_s: int = DEFAULT_LOOKBACK_S) -> dict:
    """One table of an incremental run: extract -> dedupe -> upsert -> commit watermark.

    Status is returned rather than raised so a failing table does not stop
    the others (the caller aggregates ok / partial / failed).
    """
    try:
        wm = store.get(table_name)
        ch = incremental_extract(src, track_col, wm, ceiling, lookback_s)
        ch = dedupe_changes(ch, target.pk, [track_col, *tiebreak])
        upsert_versioned(target, ch)
        store.commit(table_name, ceiling, run_id)  # only after the write succeeded
        return {"table": table_name, "status": "ok", "message": None, "bytes": target.written_bytes}
    except Exception as e:  # noqa: BLE001 - reported per table
        return {"table": table_name, "status": "failed", "message": str(e)}


@dataclass
class TableSpec:
    """What a run needs to know of one table."""

    name: str
    source: Callable[[], DataFrame]
    pk: Sequence[str]
    track_col: str
    tiebreak: Sequence[str] = ()


def run_tables(spark: SparkSession, work: dict[str, Callable[[], dict]], workers: int, timeout_s: float | None) -> list[dict]:
    """Run one function per table, ``workers`` at a time, and return their results in the given order.

    Spark runs the jobs of all threads together, each table in a scheduler pool of its own (pools share
    fairly where the session's scheduler does). The jobs of a table that takes longer than ``timeout_s``
    are cancelled by their tag, and no others.
    """
    sc = spark.sparkContext
    tags = {name: f"sync-{uuid.uuid4().hex}" for name in work}
    began: dict[str, float] = {}

    def run(name: str) -> dict:
        began[name] = time.monotonic()
        sc.addJobTag(tags[name])
        sc.setLocalProperty("spark.scheduler.pool", name)
        try:
            return work[name]()
        except Exception as e:  # noqa: BLE001 - a source that cannot be opened fails its table only
            return {"table": name, "status": "failed", "message": str(e)}
        finally:
            sc.removeJobTag(tags[name])

    results: dict[str, dict] = {}
    pool = ThreadPoolExecutor(workers)
    try:
        open_ = {pool.submit(run, name): name for name in work}
        while open_:
            done, _ = wait(open_, timeout=None if timeout_s is None else 0.2, return_when=FIRST_COMPLETED)
            for f in done:
                results.setdefault(open_.pop(f), f.result())
            for f, name in list(open_.items()):
                if timeout_s is not None and name in began and time.monotonic() - began[name] > timeout_s:
                    sc.cancelJobsWithTag(tags[name])
                    results[name] = {"table": name, "status": "failed", "message": f"timed out after {timeout_s:g} s"}
                    del open_[f]
    finally:
        pool.shutdown(wait=False)
    return [results[name] for name in work]


def run_sync(spark: SparkSession, specs: Sequence[TableSpec], root: str, ceiling, run_id: str,
             log: RunLog | None = None, lookback_s: int = DEFAULT_LOOKBACK_S, workers: int = 4, timeout_s: float | None = None) -> list[dict]:
    """An incremental run over many tables, ``workers`` of them at a time, each with its own watermark; one that
    fails or takes too long does not stop the others. The run log gets one row: ok, partial or failed."""
    started, clock = datetime.now(timezone.utc).replace(tzinfo=None), time.monotonic()
    store = WatermarkStore(spark, f"{root}/_watermarks")

    def work(s: TableSpec) -> Callable[[], dict]:
        return lambda: sync_table(s.source(), VersionedTable(spark, f"{root}/{s.name}", s.pk), store, s.name, s.track_col, ceiling, run_id, s.tiebreak, lookback_s)
    results = run_tables(spark, {s.name: work(s) for s in specs}, workers, timeout_s)
    if log is not None:
        failed = [f"{r['table']}: {r['message']}" for r in results if r["status"] != "ok"]
        log.record(run_id, "sync", run_status(results), started, time.monotonic() - clock, len(results) - len(failed),
                   sum(r.get("bytes") or 0 for r in results), "; ".join(failed) or None)
    return results


def run_status(results: Sequence[dict]) -> str:
    failed = sum(r["status"] != "ok" for r in results)
    return "ok" if failed == 0 else ("failed" if failed == len(results) else "partial")


def snapshot_all(spark: SparkSession, tables: dict[str, DataFrame], root: str, carry: Sequence[str] = ()) -> DataFrame:
    """Full dump of every table, swapped in as one, then a distributed row audit of what was written."""
    snap = Snapshot(spark, root)
    snap.publish(tables, carry)
    counts = [snap.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name in tables]
    return reduce(DataFrame.unionByName, counts)
