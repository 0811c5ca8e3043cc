"""Classification, difficulty analysis and catalog queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import classify as C
from tessera.operators import joins as J
from tessera.operators import metrics as M
from tessera.operators import profile as P
from tessera.operators.split import stratified_split
from tessera.plans import eval_queries as EQ
from tessera.plans import lm_queries as LQ
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources.tables import TABLES, Tables

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
K_CLASSES = 5

_FF_SQL = f"""
top AS (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT {K_CLASSES}),
lab AS (SELECT p_brand, row_number() OVER (ORDER BY n DESC, p_brand) - 1 AS label FROM top),
ff AS (SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS id, l.l_linestatus,
              {', '.join('l.' + f for f in FEATURES)}, lab.label
       FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN lab ON p.p_brand = lab.p_brand
       WHERE {' AND '.join('l.' + f + ' IS NOT NULL' for f in FEATURES)}),
sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws(':', id, '42')), id) - 1
                          < floor(CAST(0.2 AS DOUBLE) * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split
       FROM ff)"""


def feature_frame(spark, sf_dir):
    t = Tables(spark, sf_dir)
    top = P.rank_labels(P.top_k_groups(t.part, "p_brand", K_CLASSES), "p_brand")  # k rows
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", *FEATURES)
    p = t.part.select("p_partkey", "p_brand")
    j = J.enrich(li, p, li.l_partkey == p.p_partkey, "inner") \
         .join(F.broadcast(top.select("p_brand", F.col("label_idx").alias("label"))), "p_brand")
    j = j.dropna(subset=list(FEATURES))
    rid = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return j.select(rid.alias("id"), "l_linestatus", *FEATURES, F.col("label").cast("long").alias("label"))


def split_frame(spark, sf_dir):
    """Rows with their split; the joins below run once, as the counting passes and every consumer read the rows again."""
    return stratified_split(cut_lineage(feature_frame(spark, sf_dir)), "id", "label", 0.2, 42)


@register("feature_frame", sql="WITH " + _FF_SQL + """
SELECT id, l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax, label FROM ff""")
def q_feature_frame(spark, sf_dir):
    return feature_frame(spark, sf_dir)


@register("standardize_features", sql="WITH " + _FF_SQL + """
SELECT id, """ + ", ".join(
    f"round(CASE WHEN stddev_pop({f}) OVER () > 0 THEN ({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () ELSE 0.0 END, 6) AS {f}_z"
    for f in FEATURES) + " FROM ff")
def q_standardize_features(spark, sf_dir):
    ff = feature_frame(spark, sf_dir)
    z = C.standardize(ff, FEATURES)
    return z.select("id", *[F.round(f + "_z", 6).alias(f + "_z") for f in FEATURES])


@register("stratified_split", sql="WITH " + _FF_SQL + """
SELECT label, split, count(*) AS n FROM sp GROUP BY label, split""")
def q_stratified_split(spark, sf_dir):
    return split_frame(spark, sf_dir).groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


_BASE_PRED = """
maj AS (SELECT l_linestatus, arg_max(label, (n, -label)) AS predicted
        FROM (SELECT l_linestatus, label, count(*) AS n FROM sp WHERE split = 'train' GROUP BY ALL) GROUP BY l_linestatus),
pr AS (SELECT s.id, s.label, coalesce(m.predicted, -1) AS predicted FROM sp s LEFT JOIN maj m ON s.l_linestatus = m.l_linestatus
       WHERE s.split = 'test')"""


def _baseline_predictions(s):
    maj = C.majority_baseline(s.where(F.col("split") == "train"), "label", "l_linestatus")
    test = s.where(F.col("split") == "test")
    return test.join(maj, "l_linestatus", "left").select(
        "id", "label", F.coalesce("predicted", F.lit(-1)).cast("long").alias("predicted"))


@register("baseline_confusion", sql="WITH " + _FF_SQL + "," + _BASE_PRED + f"""
, cls AS (SELECT DISTINCT label FROM ff)
SELECT a.label AS actual, b.label AS predicted, count(pr.id) AS n
FROM cls a CROSS JOIN cls b LEFT JOIN pr ON pr.label = a.label AND pr.predicted = b.label
GROUP BY a.label, b.label""")
def q_baseline_confusion(spark, sf_dir):
    s = split_frame(spark, sf_dir)
    pr = _baseline_predictions(s)
    classes = s.select("label").distinct()
    return P.confusion_matrix(pr, "label", "predicted", classes).select("actual", "predicted", "n")


@register("baseline_accuracy", sql="WITH " + _FF_SQL + "," + _BASE_PRED + """
, bal AS (SELECT max(n) / sum(n) AS majority FROM (SELECT label, count(*) AS n FROM sp WHERE split = 'train' GROUP BY label))
SELECT round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round((SELECT majority FROM bal), 6) AS majority_share, count(*) AS n_test FROM pr""")
def q_baseline_accuracy(spark, sf_dir):
    s = split_frame(spark, sf_dir)
    pr = _baseline_predictions(s)
    train = s.where(F.col("split") == "train")
    bal = P.class_balance(train, "label").select("majority_share").limit(1)
    return pr.agg(F.round(P.accuracy(pr, "label", "predicted"), 6).alias("accuracy"),
                  F.count(F.lit(1)).alias("n_test")) \
             .select("accuracy", F.round(bal.scalar(), 6).alias("majority_share"), "n_test")


@register("mlp_classifier")
def q_mlp_classifier(spark, sf_dir):
    """MLlib MLP [4, 16, 8, 5] on the stratified train split; report on train and test."""
    s = split_frame(spark, sf_dir)
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    model = C.train_mlp(train, FEATURES, "label", [len(FEATURES), 16, 8, K_CLASSES], max_iter=100)
    pred = model.transform(s).select("split", "label", F.col("prediction").cast("long").alias("predicted"))
    maj = P.class_balance(train, "label").select("majority_share").limit(1).scalar()
    rep = pred.groupBy("split").agg(P.accuracy(pred, "label", "predicted").alias("accuracy"),
                                    F.count(F.lit(1)).alias("n"))
    return rep.select("split", "n", F.round("accuracy", 6).alias("accuracy"),
                      F.round(maj, 6).alias("majority_share"),
                      (F.col("accuracy") > maj + 0.10).alias("beats_majority_by_10pp"))


@register("mlp_confusion")
def q_mlp_confusion(spark, sf_dir):
    s = split_frame(spark, sf_dir)
    train = s.where(F.col("split") == "train")
    model = C.train_mlp(train, FEATURES, "label", [len(FEATURES), 16, 8, K_CLASSES], max_iter=100)
    pred = model.transform(s.where(F.col("split") == "test")) \
                .select("label", F.col("prediction").cast("long").alias("predicted"))
    return P.confusion_matrix(pred, "label", "predicted", s.select("label").distinct())


@register("mlp_confusion_sums", sql="WITH " + _FF_SQL + """
SELECT label AS actual, count(*) AS n, true AS all_classes, true AS loss_falls FROM sp WHERE split = 'test' GROUP BY label""")
def q_mlp_confusion_sums(spark, sf_dir):
    """Rows of the confusion matrix sum to the classes of the test split; every class has a column, and
    the trained model's loss on the train split is below that of guessing by class frequency."""
    s = cut_lineage(split_frame(spark, sf_dir))
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    model = C.train_mlp(train, FEATURES, "label", [len(FEATURES), 16, 8, K_CLASSES], max_iter=100)
    pred = model.transform(test).select("label", F.col("prediction").cast("long").alias("predicted"))
    cm = P.confusion_matrix(pred, "label", "predicted", s.select("label").distinct())
    fitted = C.log_loss(model.transform(train), "label")
    guessed = C.frequency_log_loss(train, "label")
    return cm.groupBy("actual").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) == K_CLASSES).alias("all_classes")).withColumn("loss_falls", F.lit(fitted < guessed))


# ---------------------------------------------------------------- difficulty analysis (I13)
def difficulty_rows(spark, sf_dir):
    """Per document: name perplexity of its part name x per-row quality of ``copy_spec``."""
    from tessera.operators.difficulty import name_perplexity
    lm = LQ.LM(spark, sf_dir)
    part = Tables(spark, sf_dir).part.select("p_partkey", "p_name")
    ppl = name_perplexity(part, "p_partkey", "p_name", lm).select(F.col("p_partkey").alias("id"), "name_ppl")
    preds = EQ.predictions(spark, sf_dir).where(F.col("generator") == "copy_spec")
    refs = EQ.references(spark, sf_dir)
    scores = M.example_scores(M.example_counts(preds, refs)).select("id", "bleu", F.col("tf_cosine").alias("cosine"))
    # perplexities of equal names tie; rounding to 9 decimals keeps quantile edges stable
    return scores.join(ppl.select("id", F.round("name_ppl", 9).alias("name_ppl")), "id")


_DIFF_SQL = (LQ._with(LQ._base, LQ._kn_tune, more=True) + f"""
nw AS (SELECT p_partkey, unnest({LQ.S.tokens('p_name')}) AS word, 1 AS c FROM part),
np2 AS (SELECT p_partkey, x, y, c FROM {LQ._grams('nw', 2, by='p_partkey, ', names=['x', 'y'])}),
sc AS (SELECT p_partkey, exp(-sum(c * ln({LQ._kn_sql('(SELECT d FROM best)')})) / sum(c)) AS ppl
       FROM {LQ._attach_sql('np2', 'e.p_partkey, ')} GROUP BY p_partkey),
nppl AS (SELECT p.p_partkey AS id, coalesce(sc.ppl, 3.0 * (SELECT ppl FROM best)) AS name_ppl
         FROM part p LEFT JOIN sc ON p.p_partkey = sc.p_partkey),
{EQ._PREDS.strip()},
{EQ._STATS.strip()},
{EQ._TFCOS.strip()},
rowq AS (SELECT st.id, CASE WHEN sys_len = 0 THEN 0.0 ELSE {EQ._bleu_sql(True)} / 100.0 END AS bleu, cosr.cosine, round(nppl.name_ppl, 9) AS name_ppl
         FROM st JOIN cosr ON st.generator = cosr.generator AND st.id = cosr.id JOIN nppl ON st.id = nppl.id
         WHERE st.generator = 'copy_spec')
""")


@register("difficulty_fit", sql=_DIFF_SQL + """
SELECT round(corr(name_ppl, bleu), 6) AS r, round(regr_slope(bleu, name_ppl), 6) AS slope,
       round(regr_intercept(bleu, name_ppl), 6) AS intercept, count(*) AS n FROM rowq""")
def q_difficulty_fit(spark, sf_dir):
    d = difficulty_rows(spark, sf_dir)
    return d.agg(F.round(F.corr("name_ppl", "bleu"), 6).alias("r"),
                 F.round(F.regr_slope("bleu", "name_ppl"), 6).alias("slope"),
                 F.round(F.regr_intercept("bleu", "name_ppl"), 6).alias("intercept"),
                 F.count(F.lit(1)).alias("n"))


@register("difficulty_buckets", sql=_DIFF_SQL + """
, q AS (SELECT quantile_cont(name_ppl, 0.33) AS lo, quantile_cont(name_ppl, 0.67) AS hi FROM rowq),
b AS (SELECT r.*, CASE WHEN name_ppl <= q.lo THEN 'low' WHEN name_ppl <= q.hi THEN 'mid' ELSE 'high' END AS bucket
      FROM rowq r, q)
SELECT bucket, count(*) AS n, round(avg(bleu), 4) AS bleu_mean, round(stddev_samp(bleu), 4) AS bleu_std,
       round(avg(cosine), 4) AS cosine_mean, round(stddev_samp(cosine), 4) AS cosine_std FROM b GROUP BY bucket""")
def q_difficulty_buckets(spark, sf_dir):
    # the rows feed the quantile passes and the bucketed aggregate: computed once
    d = P.quantile_buckets(cut_lineage(difficulty_rows(spark, sf_dir)), "name_ppl")
    return P.group_mean_std(d, "bucket", ["bleu", "cosine"], order=["low", "mid", "high"])


@register("difficulty_hardest", sql=_DIFF_SQL + """
SELECT id, round(name_ppl, 6) AS name_ppl, round(bleu, 6) AS bleu FROM rowq ORDER BY rowq.name_ppl DESC, id LIMIT 10""")
def q_difficulty_hardest(spark, sf_dir):
    """The ten names that the language model finds least likely."""
    d = difficulty_rows(spark, sf_dir)
    h = P.top_n(d, "name_ppl", 10, "id")
    return h.select("id", F.round("name_ppl", 6).alias("name_ppl"), F.round("bleu", 6).alias("bleu"))


# ---------------------------------------------------------------- catalog
@register("list_tables", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, true AS has_bytes FROM {t}" for t in TABLES))
def q_list_tables(spark, sf_dir):
    """Tables with row counts, largest first; their sizes on disk differ by engine, so only that there are some."""
    from tessera.sources.catalog import list_tables
    return list_tables(spark, sf_dir, TABLES).select("table_name", "n_rows", (F.col("size_bytes") > 0).alias("has_bytes"))


@register("describe_tables")
def q_describe_tables(spark, sf_dir):
    """Column name, type, nullability and ordinal of every table."""
    from functools import reduce

    from pyspark.sql import DataFrame

    from tessera.sources.catalog import describe
    parts = [describe(getattr(Tables(spark, sf_dir), t)).select(F.lit(t).alias("table_name"), "*") for t in TABLES]
    return reduce(DataFrame.unionByName, parts)
