"""Per-row language-model features: name perplexity and context windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import ngram as N


def name_perplexity(df: DataFrame, id_col: str, text_col: str, lm, out: str = "name_ppl") -> DataFrame:
    """KN bigram perplexity over all usable words of each row's text.

    Rows without a usable word get ``3 x`` the best validation perplexity.
    Transitions of a row are summed within the row, from a table of all pairs over the
    alphabet, so what is shuffled and grouped is a row per id, never one per transition.
    """
    words = T.tokenize_words(F.col(text_col))
    s = F.concat(F.lit(N.SENTINEL), F.array_join(words, N.SENTINEL), F.lit(N.SENTINEL))  # a word's end begins the next
    rows = df.select(id_col, text_col).repartition(id_col).where(F.size(words) > 0).select(id_col, N.symbol_codes(s).alias("_s"))
    rows = rows.crossJoin(F.broadcast(N.pair_costs(df.sparkSession, lm.bm, lm.best_d(), "_costs")))  # one row
    n = F.size("_s") - 1
    cost = F.zip_with(F.slice("_s", 1, n), F.slice("_s", 2, n), lambda x, y: F.get("_costs", x * N.MAX_SYMBOLS + y))
    nll = F.aggregate(cost, F.lit(0.0), lambda a, c: a + c)
    sums = rows.select(id_col, nll.alias("_nll"), n.cast("long").alias("_n")).groupBy(id_col).agg(F.sum("_nll").alias("_nll"), F.sum("_n").alias("_n"))
    scores = sums.select(id_col, F.exp(F.col("_nll") / F.col("_n")).alias("ppl"))
    fallback = F.lit(N.FALLBACK_PPL_FACTOR) * lm.best_kn_val_ppl()
    return df.join(scores, id_col, "left").withColumn(out, F.coalesce(F.col("ppl"), fallback)).drop("ppl")


def context_windows(words: DataFrame, k: int = 3) -> DataFrame:
    """(context, next, n): every ``k``-symbol context of ``'.'*k + w + '.'`` and its next symbol."""
    s = F.concat(F.lit(N.SENTINEL * k), F.col("word"), F.lit(N.SENTINEL))
    ex = words.select("c", s.alias("_s"), F.explode(F.sequence(F.lit(k), F.length(s) - 1)).alias("_i"))
    ex = ex.select(F.col("_s").substr(F.col("_i") - k + 1, F.lit(k)).alias("context"),
                   F.col("_s").substr(F.col("_i") + 1, F.lit(1)).alias("next"), "c")
    return ex.groupBy("context", "next").agg(F.sum("c").alias("n"))
