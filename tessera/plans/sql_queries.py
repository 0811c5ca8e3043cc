"""Parametrised SQL, relative time windows, epochs, log-loss and snapshots
(SURVEY A1, B5, F16, F17, H8) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numeric as NUM
from tessera.operators import joins as J
from tessera.operators import sync as SY
from tessera.plans import ml_queries as MQ
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.sql import run_sql
from tessera.sources.tables import TABLES, Tables

# ---------------------------------------------------------------- A1
SEGMENT_SQL = """
SELECT c.c_mktsegment AS segment, count(*) AS n_orders, round(sum(o.o_totalprice), 2) AS revenue
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus = {status} AND o.o_totalprice >= {min_price}
GROUP BY c.c_mktsegment"""
SEGMENT_PARAMS = {"status": "F", "min_price": 1000.0}


@register("sql_params", sql=SEGMENT_SQL.format(status="'F'", min_price="1000.0"))
def q_sql_params(spark, sf_dir):
    """Named-marker SQL over views of the given tables; Spark binds the values."""
    t = Tables(spark, sf_dir)
    return run_sql(spark, SEGMENT_SQL.format(status=":status", min_price=":min_price"), SEGMENT_PARAMS,
                   views={"orders": t.orders, "customer": t.customer})


# ---------------------------------------------------------------- B5
RECENT_MONTHS = 12


@register("recent_orders", sql=f"""
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS revenue FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL {RECENT_MONTHS} MONTH
GROUP BY o_orderpriority""")
def q_recent_orders(spark, sf_dir):
    """Orders in the 12 months before the latest order date (the data's own ``as_of``)."""
    o = Tables(spark, sf_dir).orders
    as_of = o.agg(F.max("o_orderdate")).scalar()
    since = as_of - F.expr(f"INTERVAL {RECENT_MONTHS} MONTHS")
    return o.where(F.col("o_orderdate") > since).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


# ---------------------------------------------------------------- F17
@register("event_epochs", sql="""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
       strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS utc_text,
       strptime(strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ'),
                '%Y-%m-%dT%H:%M:%SZ') = date_trunc('second', ts) AS roundtrip_ok
FROM events""")
def q_event_epochs(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("event_id", "ts")
    e = e.withColumn("epoch_s", NUM.epoch_seconds(F.col("ts")))
    e = e.withColumn("utc_text", NUM.epoch_to_utc_text(F.col("epoch_s")))
    ok = NUM.utc_text_to_timestamp(F.col("utc_text")) == F.date_trunc("second", F.col("ts"))
    return e.select("event_id", "epoch_s", "utc_text", ok.alias("roundtrip_ok"))


# ---------------------------------------------------------------- F16
@register("baseline_log_loss", sql="WITH " + MQ._FF_SQL + """,
cnt AS (SELECT l_linestatus, """ + ", ".join(
    f"sum(CASE WHEN label = {k} THEN 1 ELSE 0 END) AS c{k}" for k in range(MQ.K_CLASSES)) + """
        FROM sp WHERE split = 'train' GROUP BY l_linestatus),
te AS (SELECT s.label, """ + ", ".join(f"coalesce(c.c{k}, 0) AS c{k}" for k in range(MQ.K_CLASSES)) + """
       FROM sp s LEFT JOIN cnt c ON s.l_linestatus = c.l_linestatus WHERE s.split = 'test')
SELECT round(avg(ln(""" + " + ".join(f"(c{k} + 1)" for k in range(MQ.K_CLASSES)) + """)
                 - ln(CASE """ + " ".join(f"WHEN label = {k} THEN c{k} + 1" for k in range(MQ.K_CLASSES)) + """ END)), 6)
       AS log_loss, count(*) AS n_test FROM te""")
def q_baseline_log_loss(spark, sf_dir):
    """Log-loss of a per-status class-frequency model (Laplace +1) on the test split.

    Logits are ``ln(count + 1)`` per class, so the softmax is the smoothed
    class frequency; the per-status count table is bounded by the status
    values, and is left to Spark to join.
    """
    s = MQ.split_frame(spark, sf_dir)
    k = MQ.K_CLASSES
    cnt = s.where(F.col("split") == "train").groupBy("l_linestatus").agg(
        *[F.sum((F.col("label") == i).cast("long")).alias(f"c{i}") for i in range(k)])
    te = J.enrich(s.where(F.col("split") == "test").select("l_linestatus", "label"), cnt, "l_linestatus", "left")
    logits = F.array(*[F.log(F.coalesce(F.col(f"c{i}"), F.lit(0)) + F.lit(1.0)) for i in range(k)])
    xent = NUM.cross_entropy(logits, F.col("label"))
    return te.agg(F.round(F.avg(xent), 6).alias("log_loss"), F.count(F.lit(1)).alias("n_test"))


# ---------------------------------------------------------------- H8
@register("snapshot_tables", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def q_snapshot_tables(spark, sf_dir):
    """Full dump of every table into a new version under the shared folder, then a row audit."""
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "snapshot")
    return SY.snapshot_all(spark, {name: getattr(t, name) for name in TABLES}, root)
