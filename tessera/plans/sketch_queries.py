"""Stored quantile sketches, alias-table sampling and a report observed while writing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import alias as A
from tessera.operators import dataset as D
from tessera.operators import ngram as N
from tessera.operators import sketches as K
from tessera.plans import dataset_queries as DQ
from tessera.plans.lm_queries import LM
from tessera.plans.registry import ORACLES, register
from tessera.session import cut_lineage, scratch_path
from tessera.sources.tables import Tables

SHARES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99)


@register("daily_sketches", sql=f"""
SELECT span, share, n, true AS close_enough FROM (
  SELECT 'all' AS span, count(value) AS n FROM events
  UNION ALL SELECT 'early', count(value) FROM events WHERE ts < TIMESTAMP '2024-01-11'), (SELECT unnest({list(SHARES)}::DOUBLE[]) AS share)""")
def q_daily_sketches(spark, sf_dir):
    """Quantiles of all days and of the first ten from stored daily sketches, one day stored twice: the
    rank of every answer among the values themselves is within 1 % of the asked one."""
    path = scratch_path(spark, "sketches")
    e = Tables(spark, sf_dir).events.select("ts", "value")
    day = F.to_date("ts")
    K.write_sketches(K.sketches_by(e.where(day <= "2024-01-08"), day, "value"), path)
    K.write_sketches(K.sketches_by(e.where(day >= "2024-01-08"), day, "value"), path)
    stored = spark.read.parquet(path)
    spans = F.explode(F.when(F.col("period") < "2024-01-11", F.array(F.lit("all"), F.lit("early"))).otherwise(F.array(F.lit("all"))))
    found = cut_lineage(K.merged_quantiles(stored.withColumn("span", spans), SHARES, ["span"]))  # a row per span and share
    rows = e.where("value is not null").withColumn("span", F.explode(F.when(F.col("ts") < "2024-01-11", F.array(F.lit("all"), F.lit("early"))).otherwise(F.array(F.lit("all")))))
    ranks = (rows.withColumnRenamed("value", "r").join(F.broadcast(found), "span").groupBy("span", "share", "n")
             .agg(F.count_if(F.col("r") < F.col("value")).alias("below"), F.count_if(F.col("r") <= F.col("value")).alias("upto")))
    near = (F.col("below") / F.col("n") <= F.col("share") + 0.01) & (F.col("upto") / F.col("n") >= F.col("share") - 0.01)
    return ranks.select("span", "share", "n", near.alias("close_enough"))


SAMPLES = 200_000


@register("lm_sample_shares", sql=f"SELECT {SAMPLES} AS n_samples, true AS first_letters_close, true AS pairs_close")
def q_lm_sample_shares(spark, sf_dir):
    """Words sampled from the tuned model by alias tables: shares of first letters, and of what follows
    each letter, lie within five standard deviations of the model's probabilities."""
    lm = LM(spark, sf_dir)
    model = cut_lineage(N.cumulative_cdf(N.kn_dense(lm.vocab(), lm.bm, lm.best_d())).select("x", "y", F.col("q").alias("p")))
    tables = cut_lineage(A.alias_tables(model))
    samples = spark.range(SAMPLES).select(F.col("id").alias("sample_id"), F.lit(A.END).alias("seed_char"))
    words = cut_lineage(A.sampled_words(samples, tables))

    def close(counts):
        total = counts.groupBy("x").agg(F.sum("n").alias("total"))
        both = model.join(total, "x").join(counts, ["x", "y"], "left").fillna(0, ["n"])
        spread = 5 * F.sqrt(F.col("total") * F.col("p") * (1 - F.col("p"))) + 1
        return both.agg(F.coalesce(F.bool_and(F.abs(F.col("n") - F.col("total") * F.col("p")) <= spread), F.lit(False)).alias("c")).first()["c"]
    pairs = cut_lineage(A.transitions(words))
    first = words.groupBy(F.lit(A.END).alias("x"), F.coalesce(F.nullif(F.substring("word", 1, 1), F.lit("")), F.lit(A.END)).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return words.agg(F.count(F.lit(1)).alias("n_samples")).select("n_samples", F.lit(close(first)).alias("first_letters_close"), F.lit(close(pairs)).alias("pairs_close"))


@register("export_observed", sql=f"SELECT *, kept AS written FROM ({ORACLES['export_report']})")
def q_export_observed(spark, sf_dir):
    """The export's report, gathered while its files are written, and the rows that stand in the files."""
    ex = DQ.examples(spark, sf_dir)
    path = scratch_path(spark, "export")
    report = D.export_with_report(D.split_examples(ex.where("kept")), ex, path)
    written = spark.read.json(path).count()
    return spark.createDataFrame([{**report, "written": written}], "fetched long, kept long, skipped long, train long, val long, test long, written long")

