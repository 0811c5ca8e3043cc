"""Character n-gram language models as tables.

Scale principle: only the counting touches the corpus, and it is
pre-aggregated twice - occurrences collapse to ``(split, word, count)``
(map-side combined, so a very frequent word costs one partial row per task),
then each distinct word explodes into its character n-grams weighted by its
count. Every model table afterwards is bounded by the symbol alphabet: the
tokenizer keeps ``[a-z]{2,}`` only, so there are at most 27 symbols with the
``.`` sentinel, 27**2 bigrams and 27**3 trigrams. Those tables are the only
things broadcast.

Perplexity never loops over tokens: ``NLL = -sum c_eval(x, y) ln p(x, y)`` over
the evaluation *n-gram counts*, so scoring is a join of two small tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.split import exact_hash_split, split_counts
from tessera.session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values (reference behaviour)
# ---------------------------------------------------------------------------
SENTINEL = "."
FLOOR_P = 1e-10                      # unseen continuation / JM clamp
KN_GRID = (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.9)
JM_L3_GRID = (0.3, 0.5, 0.6, 0.7)
JM_L2_GRID = (0.2, 0.3, 0.35, 0.4)
JM_MIN_L1 = 0.01
HOLDOUT = 0.9
SEED = 42
FALLBACK_PPL_FACTOR = 3.0            # row without usable words -> 3 x best val PPL
MAX_SYMBOLS = 27                     # 26 letters + sentinel: the broadcast bound


def jm_grid() -> list[tuple[float, float, float]]:
    out = []
    for l3 in JM_L3_GRID:
        for l2 in JM_L2_GRID:
            l1 = round(1.0 - l3 - l2, 5)
            if l1 >= JM_MIN_L1:
                out.append((l3, l2, l1))
    return out


# ---------------------------------------------------------------- corpus side
def occurrences(corpus: DataFrame, text_col: str = "text") -> DataFrame:
    """(source, row_id, pos, word, occ_id): one row per kept token occurrence."""
    t = corpus.select("source", "row_id", F.posexplode(T.tokenize_words(F.col(text_col))).alias("pos", "word"))
    occ_id = F.concat_ws(":", F.col("source"), F.col("row_id").cast("string"), F.col("pos").cast("string"))
    return t.withColumn("occ_id", occ_id)


def holdout_split(occ: DataFrame, train_fraction: float = HOLDOUT, seed: int = SEED) -> DataFrame:
    """Exact ``floor(0.9 n)`` / rest split over token occurrences (G3)."""
    return exact_hash_split(occ, "occ_id", (train_fraction,), ("train", "val"), seed)


def word_counts(occ: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    """Distinct words with multiplicity per group: the only corpus-sized aggregate."""
    return occ.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("c"))


def holdout_word_counts(occ: DataFrame, by: Sequence[str] = ("split",), train_fraction: float = HOLDOUT, seed: int = SEED) -> DataFrame:
    """``word_counts`` of the occurrences that ``holdout_split`` tags: tokens are made and hashed once,
    and the splits are told apart in the counts. Few tokens are tagged by passes over them."""
    groups = [c for c in by if c != "split"]
    counts = split_counts(occ, "occ_id", train_fraction, ("train", "val"), [*groups, "word"], seed)
    if counts is None:
        return word_counts(holdout_split(occ, train_fraction, seed), by)
    return counts.select(*by, "word", "c")


def _symbols(word: Column, left_pad: int = 1) -> Column:
    return F.concat(F.lit(SENTINEL * left_pad), word, F.lit(SENTINEL))


def ngram_counts(words: DataFrame, n: int, by: Sequence[str] = ("split",), left_pad: int = 1,
                 from_pos: int = 0) -> DataFrame:
    """Weighted n-gram counts of ``'.' * left_pad + w + '.'`` from distinct-word counts.

    Output ``(by..., s1..sn, c)``. ``from_pos`` skips leading positions (used
    for the JM scoring grams, whose first position is never counted).
    """
    s = _symbols(F.col("word"), left_pad)
    pos = F.explode(F.sequence(F.lit(from_pos), F.length(s) - n)).alias("_i")
    ex = words.select(*by, "c", s.alias("_s"), pos)
    cols = [F.col("_s").substr(F.col("_i") + 1 + j, F.lit(1)).alias(f"s{j + 1}") for j in range(n)]
    ex = ex.select(*by, *cols, "c")
    return ex.groupBy(*by, *[f"s{j + 1}" for j in range(n)]).agg(F.sum("c").alias("c"))


# ---------------------------------------------------------------- model tables
@dataclass
class BigramModel:
    """Count tables of a bigram model, all bounded by the symbol alphabet."""
    bi: DataFrame        # (x, y, c)
    ctx: DataFrame       # (x, cx, followers)        c(x.), N1+(x.)
    cont: DataFrame      # (y, n_prev)               N1+(.y)
    n_pairs: Column      # scalar N1+(..)
    vocab_size: Column   # scalar |V| incl. sentinel


def bigram_model(train_words: DataFrame) -> BigramModel:
    bi = ngram_counts(train_words, 2, by=()).withColumnRenamed("s1", "x").withColumnRenamed("s2", "y")
    bi = F.broadcast(cut_lineage(bi))  # <= 27**2 rows, counted once for all that is asked of the model
    ctx = bi.groupBy("x").agg(F.sum("c").alias("cx"), F.count(F.lit(1)).alias("followers"))
    cont = bi.groupBy("y").agg(F.count(F.lit(1)).alias("n_prev"))
    # distinct pairs, and symbols: every word ends with the sentinel, so all symbols are followers or begin one
    n = bi.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct(F.when(F.col("y") != SENTINEL, F.col("y"))).alias("chars")).first()
    return BigramModel(bi, F.broadcast(ctx), F.broadcast(cont), F.lit(n["pairs"]), F.lit(n["chars"] + 1))


def vocab(train_words: DataFrame) -> DataFrame:
    """Sorted distinct characters of the training words -> index 1..; '.' = 0."""
    chars = train_words.select(F.explode(F.split(F.col("word"), "")).alias("ch")).distinct()
    w = Window.orderBy("ch")  # <= 26 rows
    v = chars.withColumn("idx", F.row_number().over(w))
    return v.unionByName(v.sparkSession.range(1).select(F.lit(SENTINEL).alias("ch"), F.lit(0).alias("idx")))


def vocab_size(train_words: DataFrame) -> Column:
    chars = train_words.select(F.explode(F.split(F.col("word"), "")).alias("ch"))
    return (chars.agg(F.count_distinct("ch")).scalar() + F.lit(1))


def _attach(pairs: DataFrame, m: BigramModel) -> DataFrame:
    """Left-join bigram components onto (x, y) rows; missing counts become 0."""
    j = pairs.join(m.bi.withColumnRenamed("c", "cxy"), ["x", "y"], "left") \
             .join(m.ctx, "x", "left").join(m.cont, "y", "left")
    return j.fillna(0, ["cxy", "cx", "followers", "n_prev"])


def laplace_p(alpha: float | Column, vsize: Column) -> Column:
    a = alpha if isinstance(alpha, Column) else F.lit(float(alpha))
    return (F.col("cxy") + a) / (F.col("cx") + a * vsize)


def kn_p(d: float | Column, n_pairs: Column) -> Column:
    dd = d if isinstance(d, Column) else F.lit(float(d))
    cont = F.when(F.col("n_prev") > 0, F.col("n_prev") / n_pairs).otherwise(F.lit(FLOOR_P))
    seen = F.greatest(F.col("cxy") - dd, F.lit(0.0)) / F.col("cx") + dd * F.col("followers") / F.col("cx") * cont
    return F.when(F.col("cx") == 0, cont).otherwise(seen)


def eval_pairs(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Evaluation bigram counts ``(by..., x, y, c)``."""
    b = ngram_counts(words, 2, by=by)
    return b.withColumnRenamed("s1", "x").withColumnRenamed("s2", "y")


def perplexity(scored: DataFrame, p: Column, by: Sequence[str] = ()) -> DataFrame:
    """``exp(-sum c ln p / sum c)`` per group, plus NLL and transition count."""
    g = scored.groupBy(*by).agg((-F.sum(F.col("c") * F.log(p))).alias("nll"), F.sum("c").alias("n"))
    return g.withColumn("ppl", F.exp(F.col("nll") / F.col("n")))


def tune_kn(val_pairs: DataFrame, m: BigramModel, grid=KN_GRID) -> DataFrame:
    """(d, ppl) for each grid value plus ``best`` flag: first strict minimum."""
    j = _attach(val_pairs, m)
    arr = F.array(*[F.struct(F.lit(i).alias("gi"), F.lit(float(d)).alias("d")) for i, d in enumerate(grid)])
    j = j.withColumn("_g", F.explode(arr)).select("*", "_g.gi", "_g.d")
    res = perplexity(j, kn_p(F.col("d"), m.n_pairs), by=("gi", "d"))
    best = res.agg(F.min(F.struct("ppl", "gi")).alias("b")).select("b.gi").scalar()
    return res.withColumn("best", F.col("gi") == best)


def symbol_codes(s: Column) -> Column:
    """Numbers of a string's symbols: the sentinel 0, letters from 1."""
    return F.transform(F.split(s, ""), lambda ch: F.when(ch == SENTINEL, 0).otherwise(F.ascii(ch) - 96))


def pair_costs(spark: SparkSession, m: BigramModel, d: float | Column, out: str) -> DataFrame:
    """``-ln p`` of all pairs over the alphabet in one row: that of ``(x, y)`` at ``27 x + y`` of their codes."""
    symbol = lambda k: F.when(k == 0, SENTINEL).otherwise(F.char(k + 96))
    k = F.col("id")
    pairs = spark.range(MAX_SYMBOLS ** 2).select("id", symbol(F.floor(k / MAX_SYMBOLS)).alias("x"), symbol(k % MAX_SYMBOLS).alias("y"))
    cost = F.struct("id", (-F.log(kn_p(d, m.n_pairs))).alias("cost"))
    return _attach(pairs, m).agg(F.transform(F.array_sort(F.collect_list(cost)), lambda r: r["cost"]).alias(out))


# ---------------------------------------------------------------- trigram JM
@dataclass
class TrigramModel:
    tri: DataFrame       # (x, y, z, c)
    tctx: DataFrame      # (x, y, cxy)
    bi: DataFrame        # (y, z, c)
    bctx: DataFrame      # (y, cy)
    uni: DataFrame       # (z, cz)
    uni_total: Column


def trigram_model(train_words: DataFrame) -> TrigramModel:
    tri = F.broadcast(cut_lineage(ngram_counts(train_words, 3, by=()).toDF("x", "y", "z", "c")))  # <= 27**3 rows
    tctx = F.broadcast(tri.groupBy("x", "y").agg(F.sum("c").alias("cxy")))
    bi = F.broadcast(cut_lineage(ngram_counts(train_words, 2, by=()).toDF("y", "z", "c")))
    bctx = F.broadcast(bi.groupBy("y").agg(F.sum("c").alias("cy")))
    uni = F.broadcast(cut_lineage(ngram_counts(train_words, 1, by=()).toDF("z", "cz")))
    total = F.lit(uni.agg(F.sum("cz")).first()[0])
    return TrigramModel(tri, tctx, bi, bctx, uni, total)


def jm_eval_grams(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Scoring trigrams: every transition of ``'..' + w + '.'`` (first context ``('.', '.')``)."""
    return ngram_counts(words, 3, by=by, left_pad=2).toDF(*by, "x", "y", "z", "c")


def jm_attach(grams: DataFrame, m: TrigramModel) -> DataFrame:
    j = grams.join(m.tri.withColumnRenamed("c", "cxyz"), ["x", "y", "z"], "left") \
             .join(m.tctx, ["x", "y"], "left") \
             .join(m.bi.withColumnRenamed("c", "cyz"), ["y", "z"], "left") \
             .join(m.bctx, "y", "left").join(m.uni, "z", "left")
    return j.fillna(0, ["cxyz", "cxy", "cyz", "cy", "cz"])


def jm_p(l3, l2, l1, uni_total: Column) -> Column:
    def lit(v):
        return v if isinstance(v, Column) else F.lit(float(v))
    uni = F.col("cz") / uni_total
    bi = F.when(F.col("cy") > 0, F.col("cyz") / F.col("cy")).otherwise(uni)
    tri = F.when(F.col("cxy") > 0, F.col("cxyz") / F.col("cxy")).otherwise(bi)
    return F.greatest(lit(l3) * tri + lit(l2) * bi + lit(l1) * uni, F.lit(FLOOR_P))


def tune_jm(val_grams: DataFrame, m: TrigramModel, grid=None) -> DataFrame:
    grid = grid or jm_grid()
    j = jm_attach(val_grams, m)
    arr = F.array(*[F.struct(F.lit(i).alias("gi"), F.lit(a).alias("l3"), F.lit(b).alias("l2"),
                             F.lit(c).alias("l1")) for i, (a, b, c) in enumerate(grid)])
    j = j.withColumn("_g", F.explode(arr)).select("*", "_g.gi", "_g.l3", "_g.l2", "_g.l1")
    res = perplexity(j, jm_p(F.col("l3"), F.col("l2"), F.col("l1"), m.uni_total), by=("gi", "l3", "l2", "l1"))
    best = res.agg(F.min(F.struct("ppl", "gi")).alias("b")).select("b.gi").scalar()
    return res.withColumn("best", F.col("gi") == best)


# ---------------------------------------------------------------- dense views
def dense_grid(v: DataFrame) -> DataFrame:
    """All (x, y) over the vocabulary, expanded inside one row (<= 27**2)."""
    arr = v.agg(F.array_sort(F.collect_list(F.struct("idx", "ch"))).alias("_v"))
    return arr.select(F.explode("_v").alias("_x"), "_v").select(F.col("_x.ch").alias("x"), F.col("_x.idx").alias("xi"),
                                                             F.explode("_v").alias("_y")) \
              .select("x", "xi", F.col("_y.ch").alias("y"), F.col("_y.idx").alias("yi"))


def kn_dense(v: DataFrame, m: BigramModel, d: float | Column) -> DataFrame:
    g = _attach(dense_grid(v), m)
    return g.select("x", "xi", "y", "yi", kn_p(d, m.n_pairs).alias("p"))


def conditional_entropy(dense: DataFrame) -> DataFrame:
    """H(next | x) in nats per context row, with the most likely next symbol."""
    return dense.groupBy("x", "xi").agg(
        (-F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p")).otherwise(F.lit(0.0)))).alias("entropy"),
        F.max_by("y", F.struct("p", -F.col("yi"))).alias("argmax_next"),
        F.sum("p").alias("row_sum"))


def cumulative_cdf(dense: DataFrame) -> DataFrame:
    """Row-normalised CDF per context in vocabulary order (sampling table)."""
    w = Window.partitionBy("x").orderBy("yi").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tot = Window.partitionBy("x")
    q = dense.withColumn("q", F.col("p") / F.sum("p").over(tot))
    return q.withColumn("cdf", F.sum("q").over(w))


def uniform01(*cols: Column) -> Column:
    """Deterministic uniform in [0, 1) from a hash of the given columns."""
    h = F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols])), 1, 13), 16, 10)
    return h.cast("double") / F.lit(float(16 ** 13))


def sample_words(seeds: DataFrame, cdf: DataFrame, max_len: int = 20) -> DataFrame:
    """Ancestral sampling from a CDF table, ``max_len`` steps of a range join.

    ``seeds`` is ``(sample_id, seed_char)``; the CDF table (<= 27**2 rows) is
    broadcast. Draws are hash-derived, so the result is deterministic.
    """
    c = cdf.select("x", "y", (F.col("cdf") - F.col("q")).alias("lo"), F.col("cdf").alias("hi"))
    # The last symbol of each row also takes u up to 1.0 (float sums may end below 1).
    last = Window.partitionBy("x")
    c = c.withColumn("hi", F.when(F.col("hi") == F.max("hi").over(last), F.lit(2.0)).otherwise(F.col("hi")))
    c = F.broadcast(c)
    cur = seeds.select("sample_id", F.col("seed_char").alias("state"), F.lit("").alias("word"),
                       F.lit(False).alias("done"))
    for step in range(max_len):
        u = uniform01(F.col("sample_id"), F.lit(step))
        cur = cur.withColumn("_u", u)
        j = cur.join(c, (cur.state == c.x) & (cur._u >= c.lo) & (cur._u < c.hi) & ~cur.done, "left")
        nxt = F.col("y")
        cur = j.select(
            "sample_id",
            F.when(F.col("done"), F.col("state")).otherwise(nxt).alias("state"),
            F.when(F.col("done") | (nxt == SENTINEL) | nxt.isNull(), F.col("word"))
             .otherwise(F.concat("word", nxt)).alias("word"),
            (F.col("done") | (nxt == SENTINEL) | nxt.isNull()).alias("done"))
    return cur.select("sample_id", "word")
