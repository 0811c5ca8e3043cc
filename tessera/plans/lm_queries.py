"""Character n-gram language-model queries and their oracles.

All queries share one corpus plan: documents.text, part.p_name and
benchmark.text tagged by source -> tokens -> exact 90/10 occurrence split ->
distinct-word counts. The DuckDB oracles are generated from one CTE template
(``_base``) so the two engines read the same recipe.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import ngram as N
from tessera.plans import sqlfrag as S
from tessera.plans.registry import register
from tessera.sources.corpus import load_sources
from tessera.session import cut_lineage
from tessera.sources.tables import Tables


# ============================================================== Spark side
class LM:
    """Model tables of one scale factor, each computed once when it is first asked for."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir
        # The text is read once to count words and locate the cut key in one go: of tokens
        # only those near the cut are stored, all others as distinct words with counts.
        occ = N.occurrences(load_sources(spark, sf_dir))
        # bounded by the distinct-word count; a reliable checkpoint cuts the corpus
        # lineage so every model table below reads it.
        self.by_source = cut_lineage(N.holdout_word_counts(occ, ("source", "split")))
        self.wc = self.by_source.groupBy("split", "word").agg(F.sum("c").alias("c"))
        self.train = self.wc.where(F.col("split") == "train").select("word", "c")
        self.val = self.wc.where(F.col("split") == "val").select("word", "c")

    @cached_property
    def bm(self):
        return N.bigram_model(self.train)

    @cached_property
    def train_pairs(self) -> DataFrame:
        return cut_lineage(N.eval_pairs(self.train))

    @cached_property
    def val_pairs(self) -> DataFrame:
        return cut_lineage(N.eval_pairs(self.val))

    @cached_property
    def _tuned(self) -> DataFrame:
        return cut_lineage(N.tune_kn(self.val_pairs, self.bm))  # a row per grid value

    def kn_tuning(self) -> DataFrame:
        return self._tuned

    @cached_property
    def _best(self):
        return self._tuned.where("best").select("d", "ppl").first() or (None, None)

    def best_d(self):
        return F.lit(self._best[0])

    def best_kn_val_ppl(self):
        return F.lit(self._best[1])

    def kn_ppl(self, pairs: DataFrame, d, by=()) -> DataFrame:
        return N.perplexity(N._attach(pairs, self.bm), N.kn_p(d, self.bm.n_pairs), by)

    def vocab(self) -> DataFrame:
        return N.vocab(self.train)


def _r(c, d=6):
    return F.round(c, d)


# ============================================================== SQL side
def _grams(words: str, n: int, pad: int = 1, from_pos: int = 0, by: str = "", names=None) -> str:
    names = names or [f"s{j + 1}" for j in range(n)]
    cols = ", ".join(f"substr(s, i + {j}, 1) AS {nm}" for j, nm in enumerate(names))
    return (f"(SELECT {by}{cols}, sum(c) AS c FROM (SELECT {by}s, c, unnest(range({1 + from_pos}, "
            f"length(s) - {n - 2})) AS i FROM (SELECT {by}'{'.' * pad}' || word || '.' AS s, c FROM {words})) "
            f"GROUP BY ALL)")


_base = f"""
src AS (
  SELECT 'documents' AS source, CAST(doc_id AS BIGINT) AS row_id, text FROM documents WHERE text IS NOT NULL AND text <> ''
  UNION ALL SELECT 'part', CAST(p_partkey AS BIGINT), p_name FROM part WHERE p_name IS NOT NULL AND p_name <> ''
  UNION ALL SELECT 'benchmark', CAST(item_id AS BIGINT), text FROM benchmark WHERE text IS NOT NULL AND text <> ''),
tl AS (SELECT source, row_id, {S.tokens('text')} AS toks FROM src),
occ AS (SELECT source, row_id, unnest(toks) AS word, unnest(range(len(toks))) AS pos FROM tl),
occk AS (SELECT source, word, concat_ws(':', source, CAST(row_id AS VARCHAR), CAST(pos AS VARCHAR)) AS occ_id FROM occ),
rk AS (SELECT source, word, row_number() OVER (ORDER BY md5(concat_ws(':', occ_id, '42')), occ_id) - 1 AS r,
              count(*) OVER () AS n FROM occk),
wc AS (SELECT CASE WHEN r < floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'val' END AS split, word,
              count(*) AS c FROM rk GROUP BY 1, 2),
trw AS (SELECT word, c FROM wc WHERE split = 'train'),
vaw AS (SELECT word, c FROM wc WHERE split = 'val'),
bi AS {_grams('trw', 2, names=['x', 'y'])},
ctx AS (SELECT x, sum(c) AS cx, count(*) AS followers FROM bi GROUP BY x),
cont AS (SELECT y, count(*) AS n_prev FROM bi GROUP BY y),
np AS (SELECT count(*) AS n_pairs FROM bi),
vs AS (SELECT count(DISTINCT ch) + 1 AS v FROM (SELECT unnest(string_split(word, '')) AS ch FROM trw)),
trp AS {_grams('trw', 2, names=['x', 'y'])},
vap AS {_grams('vaw', 2, names=['x', 'y'])}"""


def _attach_sql(pairs: str, extra_cols: str = "") -> str:
    return (f"(SELECT {extra_cols}e.x, e.y, e.c, coalesce(b.c, 0) AS cxy, coalesce(t.cx, 0) AS cx, "
            f"coalesce(t.followers, 0) AS followers, coalesce(u.n_prev, 0) AS n_prev, np.n_pairs, vs.v "
            f"FROM {pairs} e LEFT JOIN bi b ON e.x = b.x AND e.y = b.y LEFT JOIN ctx t ON e.x = t.x "
            f"LEFT JOIN cont u ON e.y = u.y, np, vs)")


def _kn_sql(d: str) -> str:
    cont = "(CASE WHEN n_prev > 0 THEN n_prev / n_pairs ELSE 1e-10 END)"
    return f"(CASE WHEN cx = 0 THEN {cont} ELSE greatest(cxy - {d}, 0) / cx + {d} * followers / cx * {cont} END)"


def _lap_sql() -> str:
    return "((cxy + CAST(1.0 AS DOUBLE)) / (cx + CAST(1.0 AS DOUBLE) * v))"


def _ppl_sql(p: str) -> str:
    return f"exp(-sum(c * ln({p})) / sum(c))"


_kn_grid = "grid AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, CAST({d!r} AS DOUBLE))" for i, d in enumerate(N.KN_GRID)) + ") g(gi, d))"
_kn_tune = f"""{_kn_grid},
kn AS (SELECT gi, d, {_ppl_sql(_kn_sql('d'))} AS ppl FROM {_attach_sql('vap')} s, grid GROUP BY gi, d),
best AS (SELECT gi, d, ppl FROM kn ORDER BY ppl, gi LIMIT 1)"""

# Trigram (JM) pieces
_tri = f"""
tri AS {_grams('trw', 3, names=['x', 'y', 'z'])},
tctx AS (SELECT x, y, sum(c) AS cxy FROM tri GROUP BY x, y),
bi2 AS (SELECT x AS y, y AS z, c FROM bi),
bctx AS (SELECT y, sum(c) AS cy FROM bi2 GROUP BY y),
uni AS {_grams('trw', 1, names=['z'])},
ut AS (SELECT sum(c) AS total FROM uni)"""


def _jm_attach(grams: str) -> str:
    return (f"(SELECT g.x, g.y, g.z, g.c, coalesce(t.c, 0) AS cxyz, coalesce(tc.cxy, 0) AS cxy, "
            f"coalesce(b.c, 0) AS cyz, coalesce(bc.cy, 0) AS cy, coalesce(u.c, 0) AS cz, ut.total "
            f"FROM {grams} g LEFT JOIN tri t ON g.x = t.x AND g.y = t.y AND g.z = t.z "
            f"LEFT JOIN tctx tc ON g.x = tc.x AND g.y = tc.y LEFT JOIN bi2 b ON g.y = b.y AND g.z = b.z "
            f"LEFT JOIN bctx bc ON g.y = bc.y LEFT JOIN uni u ON g.z = u.z, ut)")


def _jm_sql(l3: str, l2: str, l1: str) -> str:
    uni = "(cz / total)"
    bi = f"(CASE WHEN cy > 0 THEN cyz / cy ELSE {uni} END)"
    tri = f"(CASE WHEN cxy > 0 THEN cxyz / cxy ELSE {bi} END)"
    return f"greatest({l3} * {tri} + {l2} * {bi} + {l1} * {uni}, 1e-10)"


_jm_grid = "jgrid AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE), CAST({c!r} AS DOUBLE))"
    for i, (a, b, c) in enumerate(N.jm_grid())) + ") g(gi, l3, l2, l1))"
_jm_tune = f"""{_tri},
vag AS {_grams('vaw', 3, pad=2, names=['x', 'y', 'z'])},
trg AS {_grams('trw', 3, pad=2, names=['x', 'y', 'z'])},
{_jm_grid},
jm AS (SELECT gi, l3, l2, l1, {_ppl_sql(_jm_sql('l3', 'l2', 'l1'))} AS ppl FROM {_jm_attach('vag')} s, jgrid
       GROUP BY gi, l3, l2, l1),
jbest AS (SELECT gi, l3, l2, l1, ppl FROM jm ORDER BY ppl, gi LIMIT 1)"""


def _with(*parts: str, more: bool = False) -> str:
    """``WITH`` clause from CTE fragments; ``more`` leaves it open for further CTEs."""
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + (",\n" if more else "\n")


# ============================================================== queries
@register("lm_word_split", sql=_with(_base) + """
SELECT split, CAST(sum(c) AS BIGINT) AS n_tokens, count(*) AS n_distinct FROM wc GROUP BY split""")
def q_lm_word_split(spark, sf_dir):
    lm = LM(spark, sf_dir)
    return lm.wc.groupBy("split").agg(F.sum("c").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct"))


@register("lm_vocab", sql=_with(_base) + """
SELECT ch, CAST(row_number() OVER (ORDER BY ch) AS INTEGER) AS idx
FROM (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM trw)
UNION ALL SELECT '.', CAST(0 AS INTEGER)""")
def q_lm_vocab(spark, sf_dir):
    return LM(spark, sf_dir).vocab().select("ch", F.col("idx").cast("int").alias("idx"))


@register("lm_unigrams", sql=_with(_base) + f"""
SELECT z AS sym, CAST(c AS BIGINT) AS c FROM {_grams('trw', 1, names=['z'])}""")
def q_lm_unigrams(spark, sf_dir):
    lm = LM(spark, sf_dir)
    return N.ngram_counts(lm.train, 1, by=()).select(F.col("s1").alias("sym"), "c")


@register("lm_bigrams", sql=_with(_base) + """
SELECT b.x, b.y, CAST(b.c AS BIGINT) AS c, CAST(t.cx AS BIGINT) AS cx FROM bi b JOIN ctx t ON b.x = t.x""")
def q_lm_bigrams(spark, sf_dir):
    bm = LM(spark, sf_dir).bm
    return bm.bi.join(bm.ctx, "x").select("x", "y", "c", "cx")


@register("lm_trigrams", sql=_with(_base, _tri) + """
SELECT t.x, t.y, t.z, CAST(t.c AS BIGINT) AS c, CAST(tc.cxy AS BIGINT) AS cxy
FROM tri t JOIN tctx tc ON t.x = tc.x AND t.y = tc.y""")
def q_lm_trigrams(spark, sf_dir):
    tm = N.trigram_model(LM(spark, sf_dir).train)
    return tm.tri.join(tm.tctx, ["x", "y"]).select("x", "y", "z", "c", "cxy")


@register("lm_continuation", sql=_with(_base) + """
SELECT s.sym, coalesce(u.n_prev, 0) AS n_prev, coalesce(t.followers, 0) AS followers, np.n_pairs
FROM (SELECT x AS sym FROM ctx UNION SELECT y FROM cont) s
LEFT JOIN cont u ON s.sym = u.y LEFT JOIN ctx t ON s.sym = t.x, np""")
def q_lm_continuation(spark, sf_dir):
    bm = LM(spark, sf_dir).bm
    syms = bm.ctx.select(F.col("x").alias("sym")).union(bm.cont.select(F.col("y").alias("sym"))).distinct()
    j = syms.join(bm.cont, syms.sym == bm.cont.y, "left").join(bm.ctx, syms.sym == bm.ctx.x, "left")
    return j.select("sym", F.coalesce("n_prev", F.lit(0)).alias("n_prev"),
                    F.coalesce("followers", F.lit(0)).alias("followers"), bm.n_pairs.alias("n_pairs"))


@register("lm_laplace_ppl", sql=_with(_base) + f"""
SELECT (SELECT round({_ppl_sql(_lap_sql())}, 6) FROM {_attach_sql('trp')}) AS train_ppl,
       (SELECT round({_ppl_sql(_lap_sql())}, 6) FROM {_attach_sql('vap')}) AS val_ppl""")
def q_lm_laplace_ppl(spark, sf_dir):
    lm = LM(spark, sf_dir)
    p = N.laplace_p(1.0, lm.bm.vocab_size)
    tr = N.perplexity(N._attach(lm.train_pairs, lm.bm), p).select(_r(F.col("ppl")).alias("train_ppl"))
    va = N.perplexity(N._attach(lm.val_pairs, lm.bm), p).select(_r(F.col("ppl")).alias("val_ppl"))
    return tr.select("train_ppl", va.select("val_ppl").scalar().alias("val_ppl"))


@register("lm_kn_tune", sql=_with(_base, _kn_tune) + """
SELECT gi, d, round(ppl, 6) AS ppl, gi = (SELECT gi FROM best) AS best FROM kn""")
def q_lm_kn_tune(spark, sf_dir):
    t = LM(spark, sf_dir).kn_tuning()
    return t.select("gi", "d", _r(F.col("ppl")).alias("ppl"), "best")


@register("lm_jm_tune", sql=_with(_base, _jm_tune) + """
SELECT gi, l3, l2, l1, round(ppl, 6) AS ppl, gi = (SELECT gi FROM jbest) AS best FROM jm""")
def q_lm_jm_tune(spark, sf_dir):
    lm = LM(spark, sf_dir)
    tm = N.trigram_model(lm.train)
    t = N.tune_jm(N.jm_eval_grams(lm.val), tm)
    return t.select("gi", "l3", "l2", "l1", _r(F.col("ppl")).alias("ppl"), "best")


@register("lm_model_comparison", sql=_with(_base, _kn_tune, _jm_tune) + f"""
SELECT 'laplace' AS model, (SELECT round({_ppl_sql(_lap_sql())}, 6) FROM {_attach_sql('trp')}) AS train_ppl,
       (SELECT round({_ppl_sql(_lap_sql())}, 6) FROM {_attach_sql('vap')}) AS val_ppl
UNION ALL
SELECT 'kneser_ney', (SELECT round({_ppl_sql(_kn_sql('(SELECT d FROM best)'))}, 6) FROM {_attach_sql('trp')}),
       (SELECT round(ppl, 6) FROM best)
UNION ALL
SELECT 'jelinek_mercer',
       (SELECT round({_ppl_sql(_jm_sql('(SELECT l3 FROM jbest)', '(SELECT l2 FROM jbest)', '(SELECT l1 FROM jbest)'))}, 6)
        FROM {_jm_attach('trg')}),
       (SELECT round(ppl, 6) FROM jbest)
UNION ALL
SELECT 'uniform', (SELECT CAST(v AS DOUBLE) FROM vs), (SELECT CAST(v AS DOUBLE) FROM vs)""")
def q_lm_model_comparison(spark, sf_dir):
    lm = LM(spark, sf_dir)
    lap = N.laplace_p(1.0, lm.bm.vocab_size)
    lap_tr = N.perplexity(N._attach(lm.train_pairs, lm.bm), lap).select("ppl").scalar()
    lap_va = N.perplexity(N._attach(lm.val_pairs, lm.bm), lap).select("ppl").scalar()
    best = lm.kn_tuning().where("best")
    kn_tr = lm.kn_ppl(lm.train_pairs, best.select("d").scalar()).select("ppl").scalar()
    kn_va = best.select("ppl").scalar()
    tm = N.trigram_model(lm.train)
    jt = N.tune_jm(N.jm_eval_grams(lm.val), tm).where("best")
    l3, l2, l1 = (jt.select(c).scalar() for c in ("l3", "l2", "l1"))
    jm_tr = N.perplexity(N.jm_attach(N.jm_eval_grams(lm.train), tm), N.jm_p(l3, l2, l1, tm.uni_total)) \
             .select("ppl").scalar()
    jm_va = jt.select("ppl").scalar()
    v = lm.bm.vocab_size.cast("double")
    rows = F.array(
        F.struct(F.lit("laplace").alias("model"), _r(lap_tr).alias("train_ppl"), _r(lap_va).alias("val_ppl")),
        F.struct(F.lit("kneser_ney").alias("model"), _r(kn_tr).alias("train_ppl"), _r(kn_va).alias("val_ppl")),
        F.struct(F.lit("jelinek_mercer").alias("model"), _r(jm_tr).alias("train_ppl"), _r(jm_va).alias("val_ppl")),
        F.struct(F.lit("uniform").alias("model"), v.alias("train_ppl"), v.alias("val_ppl")))
    return spark.range(1).select(F.inline(rows))


_dense = """
voc AS (SELECT ch, row_number() OVER (ORDER BY ch) AS idx FROM (SELECT DISTINCT unnest(string_split(word, '')) AS ch FROM trw)
        UNION ALL SELECT '.', 0),
dg AS (SELECT a.ch AS x, a.idx AS xi, b.ch AS y, b.idx AS yi, 0 AS c FROM voc a, voc b)"""


def _dense_kn():
    return (f"dk AS (SELECT x, xi, y, yi, {_kn_sql('(SELECT d FROM best)')} AS p "
            f"FROM (SELECT d.xi, d.yi, a.* FROM {_attach_sql('dg')} a JOIN dg d ON a.x = d.x AND a.y = d.y))")


@register("lm_entropy", sql=_with(_base, _kn_tune, _dense, _dense_kn()) + """
SELECT x, round(-sum(CASE WHEN p > 0 THEN p * ln(p) ELSE 0 END), 6) AS entropy,
       list(y ORDER BY p DESC, yi)[1] AS argmax_next, round(sum(p), 6) AS row_sum
FROM dk GROUP BY x""")
def q_lm_entropy(spark, sf_dir):
    lm = LM(spark, sf_dir)
    dense = N.kn_dense(lm.vocab(), lm.bm, lm.best_d())
    e = N.conditional_entropy(dense)
    return e.select("x", _r(F.col("entropy")).alias("entropy"), "argmax_next", _r(F.col("row_sum")).alias("row_sum"))


@register("lm_log_prob_matrix", sql=_with(_base, _kn_tune, _dense, _dense_kn()) + """
SELECT x, y, round(ln(p), 6) AS logp FROM dk""")
def q_lm_log_prob_matrix(spark, sf_dir):
    lm = LM(spark, sf_dir)
    dense = N.kn_dense(lm.vocab(), lm.bm, lm.best_d())
    return dense.select("x", "y", _r(F.log("p")).alias("logp"))


@register("lm_cdf", sql=_with(_base, _kn_tune, _dense, _dense_kn()) + """
SELECT x, y, round(sum(p / tot) OVER (PARTITION BY x ORDER BY yi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cdf
FROM (SELECT *, sum(p) OVER (PARTITION BY x) AS tot FROM dk)""")
def q_lm_cdf(spark, sf_dir):
    lm = LM(spark, sf_dir)
    c = N.cumulative_cdf(N.kn_dense(lm.vocab(), lm.bm, lm.best_d()))
    return c.select("x", "y", _r(F.col("cdf")).alias("cdf"))


@register("lm_name_ppl", sql=_with(_base, _kn_tune, more=True) + f"""
nw AS (SELECT p_partkey, unnest({S.tokens('p_name')}) AS word, 1 AS c FROM part),
np2 AS (SELECT p_partkey, x, y, c FROM {_grams('nw', 2, by='p_partkey, ', names=['x', 'y'])}),
sc AS (SELECT p_partkey, exp(-sum(c * ln({_kn_sql('(SELECT d FROM best)')})) / sum(c)) AS ppl
       FROM {_attach_sql('np2', 'e.p_partkey, ')} GROUP BY p_partkey)
SELECT p.p_partkey, round(coalesce(sc.ppl, 3.0 * (SELECT ppl FROM best)), 6) AS name_ppl
FROM part p LEFT JOIN sc ON p.p_partkey = sc.p_partkey""")
def q_lm_name_ppl(spark, sf_dir):
    from tessera.operators.difficulty import name_perplexity
    lm = LM(spark, sf_dir)
    part = Tables(spark, sf_dir).part
    r = name_perplexity(part, "p_partkey", "p_name", lm)
    return r.select("p_partkey", _r(F.col("name_ppl")).alias("name_ppl"))


@register("lm_per_source_ppl", sql=_with(_base, _kn_tune, more=True) + f"""
sw AS (SELECT source, word, count(*) AS c FROM rk GROUP BY source, word),
sp AS (SELECT source, x, y, c FROM {_grams('sw', 2, by='source, ', names=['x', 'y'])})
SELECT source, CAST((SELECT count(*) FROM rk r WHERE r.source = a.source) AS BIGINT) AS n_words,
       round(exp(-sum(c * ln({_kn_sql('(SELECT d FROM best)')})) / sum(c)), 6) AS ppl
FROM {_attach_sql('sp', 'e.source, ')} a GROUP BY source""")
def q_lm_per_source_ppl(spark, sf_dir):
    lm = LM(spark, sf_dir)
    sw = lm.by_source.groupBy("source", "word").agg(F.sum("c").alias("c"))
    pairs = N.eval_pairs(sw, by=("source",))
    r = lm.kn_ppl(pairs, lm.best_d(), by=("source",))
    nw = sw.groupBy("source").agg(F.sum("c").alias("n_words"))
    return r.join(nw, "source").select("source", "n_words", _r(F.col("ppl")).alias("ppl"))


@register("lm_corpus_profile", sql=_with(_base) + """
SELECT coalesce(source, 'TOTAL') AS source, count(*) AS n_words, min(length(word)) AS min_len,
       max(length(word)) AS max_len, round(avg(length(word)), 6) AS avg_len
FROM rk GROUP BY ROLLUP (source)""")
def q_lm_corpus_profile(spark, sf_dir):
    occ = N.occurrences(load_sources(spark, sf_dir))
    r = occ.rollup("source").agg(F.count(F.lit(1)).alias("n_words"), F.min(F.length("word")).alias("min_len"),
                                 F.max(F.length("word")).alias("max_len"), _r(F.avg(F.length("word"))).alias("avg_len"))
    return r.select(F.coalesce("source", F.lit("TOTAL")).alias("source"), "n_words", "min_len", "max_len", "avg_len")


@register("lm_training_pairs", sql=_with(_base, _dense) + """
SELECT a.idx AS xi, b.idx AS yi, CAST(t.c AS BIGINT) AS n FROM trp t JOIN voc a ON t.x = a.ch JOIN voc b ON t.y = b.ch""")
def q_lm_training_pairs(spark, sf_dir):
    lm = LM(spark, sf_dir)
    v = F.broadcast(lm.vocab())  # <= 27 rows
    p = lm.train_pairs.join(v.select(F.col("ch").alias("x"), F.col("idx").alias("xi")), "x") \
                      .join(v.select(F.col("ch").alias("y"), F.col("idx").alias("yi")), "y")
    return p.select("xi", "yi", F.col("c").alias("n"))


@register("lm_top_followers", sql=_with(_base) + """
SELECT y, CAST(c AS BIGINT) AS c FROM bi WHERE x = '.' ORDER BY c DESC, y LIMIT 5""")
def q_lm_top_followers(spark, sf_dir):
    bm = LM(spark, sf_dir).bm
    return bm.bi.where(F.col("x") == ".").orderBy(F.col("c").desc(), "y").limit(5).select("y", "c")


@register("lm_context_windows", sql=_with(_base, more=True) + """
cw AS (SELECT s, c, unnest(range(4, length(s) + 1)) AS i FROM (SELECT '...' || word || '.' AS s, c FROM trw))
SELECT substr(s, i - 3, 3) AS context, substr(s, i, 1) AS next, CAST(sum(c) AS BIGINT) AS n FROM cw GROUP BY 1, 2""")
def q_lm_context_windows(spark, sf_dir):
    from tessera.operators.difficulty import context_windows
    return context_windows(LM(spark, sf_dir).train, 3)


@register("lm_samples")
def q_lm_samples(spark, sf_dir):
    """Ancestral samples from the tuned KN model: 10 unconditional, 8 seeded with 't'."""
    lm = LM(spark, sf_dir)
    # The CDF table (<= 27**2 rows) is checkpointed so the 20-step loop below
    # joins a small scan instead of re-planning the whole model each step.
    cdf = cut_lineage(N.cumulative_cdf(N.kn_dense(lm.vocab(), lm.bm, lm.best_d())))
    seeds = spark.range(18).select(F.col("id").alias("sample_id"),
                                   F.when(F.col("id") < 10, F.lit(".")).otherwise(F.lit("t")).alias("seed_char"))
    return N.sample_words(seeds, cdf, 20)
