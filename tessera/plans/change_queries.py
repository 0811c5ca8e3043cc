"""Snapshot differences, day-partitioned extraction and the change feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import landing as L
from tessera.operators import snapshot_diff as D
from tessera.operators import sync as Y
from tessera.plans.registry import register
from tessera.session import cut_lineage, scratch_path
from tessera.sources.tables import Tables
from tessera.streaming import change_feed as C

SYNCED_TO = "2024-01-20 00:00:00"


# ---------------------------------------------------------------- differences with deletes
_ORDER_STATES = """
lim AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey)) // 4 AS cut FROM orders),
old AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey < cut THEN NULL ELSE o_totalprice END AS o_totalprice
        FROM orders, lim WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey < cut)),
new AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders, lim WHERE NOT (o_orderkey % 13 = 0 AND o_orderkey < cut))"""


def _order_states(spark, sf_dir):
    """Two states of the orders: rows below a quarter of the keys were added, changed and deleted."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    low, high = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    cut = 0 if low is None else low + (high - low) // 4
    recent = F.col("o_orderkey") < cut
    key = F.col("o_orderkey")
    price = F.when(~((key % 7 == 0) & recent), F.col("o_totalprice"))
    old = o.where(~((key % 11 == 0) & recent)).withColumn("o_totalprice", price)
    return old, o.where(~((key % 13 == 0) & recent))


@register("snapshot_diff", sql=f"""
WITH {_ORDER_STATES}
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, n.o_orderstatus, n.o_totalprice,
       CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old o FULL OUTER JOIN new n USING (o_orderkey)
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice""")
def q_snapshot_diff(spark, sf_dir):
    """Inserted, changed and deleted orders between two states; key ranges that agree are not joined."""
    old, new = _order_states(spark, sf_dir)
    return D.snapshot_diff(old, new, ["o_orderkey"])


@register("snapshot_repair", sql=f"WITH {_ORDER_STATES} SELECT * FROM new")
def q_snapshot_repair(spark, sf_dir):
    """The replica after the difference is applied, read back from its written form: the source, deletes included."""
    old, new = _order_states(spark, sf_dir)
    root = scratch_path(spark, "repair")
    old.write.parquet(f"{root}/replica")
    replica = spark.read.parquet(f"{root}/replica")
    changes = cut_lineage(D.snapshot_diff(replica, new, ["o_orderkey"]))
    D.apply_diff(replica, changes, ["o_orderkey"]).write.parquet(f"{root}/repaired")
    return spark.read.parquet(f"{root}/repaired")


@register("snapshot_diff_composite", sql="""
SELECT user_id, event_type, CASE WHEN user_id % 3 = 0 THEN 'insert' WHEN user_id % 5 = 0 THEN 'delete' ELSE 'update' END AS change
FROM (SELECT DISTINCT user_id, event_type FROM events)
WHERE user_id % 3 = 0 OR user_id % 5 = 0 OR user_id % 7 = 0""")
def q_snapshot_diff_composite(spark, sf_dir):
    """The same over a key of two columns, of which the first is text: buckets by hash."""
    e = Tables(spark, sf_dir).events.groupBy("event_type", "user_id").agg(F.max("event_id").alias("last"))
    old = e.where("user_id % 3 <> 0").withColumn("last", F.when(F.col("user_id") % 7 == 0, -1 - F.col("last")).otherwise(F.col("last")))
    new = e.where("user_id % 5 <> 0 or user_id % 3 = 0")
    return D.snapshot_diff(old, new, ["event_type", "user_id"], 64).select("user_id", "event_type", "change")


@register("sync_repair", sql=f"""
WITH ch AS (SELECT user_id, event_type, max(event_id) AS last, max(ts) AS ts FROM events WHERE ts < TIMESTAMP '{SYNCED_TO}' GROUP BY user_id, event_type)
SELECT user_id, event_type, CASE WHEN user_id % 4 = 1 THEN -last ELSE last END AS last, ts FROM ch WHERE user_id % 4 <> 2""")
def q_sync_repair(spark, sf_dir):
    """A replica after an incremental run, then of a source that lost rows and changed others without a
    newer timestamp: the next run sees nothing of it, the repair makes the replica equal to the source."""
    root = scratch_path(spark, "repair")
    e = Tables(spark, sf_dir).events.where(F.col("ts") < F.lit(SYNCED_TO).cast("timestamp_ntz"))
    source = e.groupBy("user_id", "event_type").agg(F.max("event_id").alias("last"), F.max("ts").alias("ts"))
    target = Y.VersionedTable(spark, f"{root}/events", ["user_id", "event_type"])
    store = Y.WatermarkStore(spark, f"{root}/_watermarks")
    later = source.where("user_id % 4 <> 2").withColumn("last", F.when(F.col("user_id") % 4 == 1, -F.col("last")).otherwise(F.col("last")))
    for rows, ceiling in ((source, SYNCED_TO), (later, "2024-03-01 00:00:00")):
        done = Y.sync_table(rows, target, store, "events", "ts", ceiling, ceiling)
        if done["status"] != "ok":
            raise RuntimeError(f"sync failed: {done}")
    Y.repair_from_source(target, later)
    return target.read().select("user_id", "event_type", "last", "ts")


# ---------------------------------------------------------------- extraction by partition
WATERMARK, CEILING, LOOKBACK_S = "2024-01-15 00:00:00", "2024-01-20 00:00:00", 300


@register("landing_extract", sql=f"""
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '{WATERMARK}' - INTERVAL {LOOKBACK_S} SECOND AND ts < TIMESTAMP '{CEILING}'""")
def q_landing_extract(spark, sf_dir):
    """Events landed by day, two of the days landed again in whole after a torn first load; the window reads its days only."""
    path = scratch_path(spark, "landing")
    e = Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    again = F.to_date("ts").isin("2024-01-16", "2024-01-19")
    L.write_days(e.where(~again | (F.col("event_id") % 2 == 0)), path, "ts")
    L.write_days(e.where(again), path, "ts")
    low = F.expr(f"TIMESTAMP_NTZ '{WATERMARK}' - INTERVAL {LOOKBACK_S} SECONDS")
    low = spark.range(1).select(low.alias("t")).first()["t"]
    return L.extract_days(spark, path, "ts", low, CEILING)


# ---------------------------------------------------------------- change feed in event time
DELAY, DELIVERIES = "3 hours", 3


@register("change_feed", sql="SELECT event_id, ts, user_id, event_type, value FROM events")
def q_change_feed(spark, sf_dir):
    """Every event delivered two or three times, hours apart, in deliveries that follow each other: each is taken once."""
    root = scratch_path(spark, "feed")
    e = C.event_time_column(Tables(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value"), "ts")
    # delivered once, an hour later again, and some two hours later a third time
    times = F.sequence(F.lit(0), F.when(F.col("event_id") % 4 == 0, 2).otherwise(1))
    sent = e.withColumn("copy", F.explode(times)).withColumn("at", F.col("ts") + F.make_dt_interval(hours="copy"))
    low, high = sent.agg(F.min(F.col("at").cast("double")), F.max(F.col("at").cast("double"))).first()
    late = 0
    for k in range(DELIVERIES):
        step = ((high or 0.0) - (low or 0.0)) / DELIVERIES
        at = F.floor((F.col("at").cast("double") - F.lit(low or 0.0)) / F.lit(step or 1.0))
        sent.where(F.least(at, F.lit(DELIVERIES - 1)) == k).select(e.columns).write.mode("append").parquet(f"{root}/feed")
        late += C.run_feed(spark, f"{root}/feed", e.schema, f"{root}/taken", f"{root}/_checkpoint", ["event_id"], "ts", DELAY, files_per_batch=1000).rows_late
    if late:
        raise RuntimeError(f"{late} rows came later than the watermark")
    return spark.read.parquet(f"{root}/taken").withColumn("ts", F.col("ts").cast("timestamp_ntz"))

