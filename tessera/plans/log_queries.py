"""Training logs: numbered lines, run comparison, tailing as a stream; metadata as VARIANT."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import runs as R
from tessera.plans.registry import register
from tessera.plans.sync_queries import product_docs
from tessera.session import scratch_path
from tessera.sources import log_lines as G
from tessera.sources.tables import Tables
from tessera.streaming import log_tail as S

# events as the log of a training run: ten events are a step; purchases are evaluations, the last event a summary
_EVAL = "purchase"


def _log_rows(events):
    """``event_id, line`` of the log that a run over ``events`` writes."""
    step = (F.col("event_id") / 10).cast("long").alias("step")
    number = F.round("value", 6)
    line = F.to_json(F.struct(step, F.when(F.col("event_type") == _EVAL, number).alias("eval_loss"),
                              F.when(F.col("event_type") != _EVAL, number).alias("loss")))
    return events.select("event_id", line.alias("line"))


def _write_log(events, path):
    """Segments in event order, as a run that rotates its log leaves them."""
    _log_rows(events).repartitionByRange("event_id").sortWithinPartitions("event_id").select("line").write.text(path)


@register("numbered_lines", sql="""
SELECT line_no, CAST(event_id // 10 AS BIGINT) AS step, round(value, 6) AS value
FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS line_no FROM events)""")
def q_numbered_lines(spark, sf_dir):
    """Every line of a log of all events with its number in the log, whichever task read it."""
    path = scratch_path(spark, "log")
    _write_log(Tables(spark, sf_dir).events, path)
    rows = G.read_metrics(spark, path)
    return rows.select("line_no", "step", F.coalesce("eval_loss", "loss").alias("value"))


@register("compare_runs", sql=f"""
WITH e AS (SELECT *, event_id // 10 AS step, user_id % 2 AS run FROM events WHERE event_type = '{_EVAL}'),
v AS (SELECT run, step, round(arg_max(value, event_id), 6) AS eval_loss FROM e GROUP BY run, step),
a AS (SELECT * FROM v WHERE run = 0), b AS (SELECT * FROM v WHERE run = 1)
SELECT CAST(coalesce(a.step, b.step) AS BIGINT) AS step, a.eval_loss AS eval_loss_a, b.eval_loss AS eval_loss_b FROM a FULL OUTER JOIN b ON a.step = b.step""")
def q_compare_runs(spark, sf_dir):
    """Logs of two runs, written in segments and read by many tasks: evaluations side by side by
    step, of a step that occurs several times its last line."""
    e = Tables(spark, sf_dir).events
    logs = []
    for run in (0, 1):
        path = scratch_path(spark, f"run{run}")
        _write_log(e.where(F.col("user_id") % 2 == run), path)
        logs.append(G.read_metrics(spark, path))
    return R.compare_eval(*logs, keys=("eval_loss",))


@register("log_tail", sql="""
SELECT 'log' || CAST(user_id % 5 AS VARCHAR) AS file, row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id) - 1 AS line_no,
       CAST(event_id // 10 AS BIGINT) AS step, round(value, 6) AS value FROM events""")
def q_log_tail(spark, sf_dir):
    """Five logs that grow in three appends, cut within lines, some bytes sent twice and some before
    their turn: the stream's lines are those of one read of the whole logs."""
    root = scratch_path(spark, "tail")
    e = Tables(spark, sf_dir).events
    lines = _log_rows(e).join(e.select("event_id", F.concat(F.lit("log"), (F.col("user_id") % 5).cast("string")).alias("file")), "event_id")
    # a chunk holds the lines of some events; its place follows from the sizes of those before it
    line = F.concat("line", F.lit("\n"))
    part = (F.col("event_id") / 200).cast("long")
    chunks = lines.groupBy("file", part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", line.alias("line")))), lambda x: x["line"]), "").alias("data"))
    from pyspark.sql import Window
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("data", F.encode("data", "utf-8")).withColumn("start", F.coalesce(F.sum(F.octet_length("data").cast("long")).over(before), F.lit(0).cast("long")))
    half = F.greatest(F.lit(1), (F.octet_length("data") / 3).cast("int"))
    pieces = chunks.select("file", "part", F.explode(F.array(
        F.struct(F.lit(0).alias("k"), F.col("start").alias("start"), F.substring("data", F.lit(1), half).alias("data")),
        F.struct(F.lit(1).alias("k"), (F.col("start") + half).alias("start"), F.substring("data", half + 1, F.octet_length("data")).alias("data")),
        F.struct(F.lit(2).alias("k"), F.col("start").alias("start"), F.substring("data", F.lit(1), half * 2).alias("data")))).alias("c"))
    pieces.select("file", "part", "c.*").write.parquet(f"{root}/pieces")
    pieces = spark.read.parquet(f"{root}/pieces")
    out = None
    for turn in range(3):
        # of every third part the head comes an append after its tail
        due = F.least(F.lit(2), F.pmod("part", F.lit(3)) + F.when((F.col("k") == 0) & (F.col("part") % 2 == 0), 1).otherwise(0))
        due = F.when(F.col("k") == 2, 2).otherwise(due)
        pieces.where(due == turn).select("file", "start", "data").write.mode("append").parquet(f"{root}/chunks")
        out = S.tail_logs(spark, f"{root}/chunks", f"{root}/lines", f"{root}/_checkpoint")
    return G.parse_metrics(out).select("file", "line_no", "step", F.coalesce("eval_loss", "loss").alias("value"))


@register("metadata_by_brand", sql="""
SELECT p_brand AS brand, count(*) AS n, CAST(sum(p_retailprice) AS DECIMAL(38,2)) AS price_sum,
       count(*) FILTER (WHERE p_retailprice > 1500) AS n_dear
FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey GROUP BY p_brand""")
def q_metadata_by_brand(spark, sf_dir):
    """Composed documents stored with their metadata as VARIANT, and grouped by fields of it."""
    path = scratch_path(spark, "metadata")
    docs = product_docs(spark, sf_dir)
    docs.select("source_table", "source_id", "content", F.parse_json("metadata").alias("metadata")).write.parquet(path)
    stored = spark.read.parquet(path)
    brand = F.variant_get("metadata", "$.brand", "string")
    price = F.try_variant_get("metadata", "$.price", "decimal(12,2)")
    return stored.groupBy(brand.alias("brand")).agg(F.count(F.lit(1)).alias("n"), F.sum(price).cast("decimal(38,2)").alias("price_sum"),
                                                    F.count(F.when(price > 1500, 1)).alias("n_dear"))
