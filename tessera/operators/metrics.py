"""Generation-quality metrics over a long ``(generator, id, reference, prediction)`` frame.

Predictions meet their references in one join on ``id``: only texts are shuffled.
What needs two texts together (clipped n-gram matches, term-count products, common
subsequences) is counted by one Arrow UDF, a batch of pairs at once (``pair_counts``);
a reference is cut once for the predictions that follow each other. Scores, averages
and the corpus sums are one aggregate over these counts.

* BLEU: corpus BLEU from summed counts, sentence BLEU per (generator, id).
* ROUGE-L: bit-parallel LCS (one big-int update per token of the prediction), in the same pass.
* Cosine: term-frequency vectors; ``embedding_cosine`` takes any embedding model.
* Length ratio: a column expression.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import bleu as B
from tessera.operators.pair_counts import Pairs, Words, lcs_length, renumbered, stems, terms_of  # noqa: F401
from tessera.operators.udf import Model, embed

ORDERS = range(1, B.MAX_ORDER + 1)
#: What a pair of texts is counted for, and the counts of each.
BLEU, COSINE, ROUGE = "bleu", "cosine", "rouge"
COUNTS = {BLEU: [*[f"m{n}" for n in ORDERS], "sys_len", "ref_len"], COSINE: ["dot", "pp", "rr"], ROUGE: ["lcs", "pred_terms", "ref_terms"]}


def pair_texts(preds: DataFrame, refs: DataFrame, how: str = "inner") -> DataFrame:
    """``(generator, id, prediction, reference)``."""
    return preds.join(refs, "id", how).select("generator", "id", "prediction", "reference")


# ---------------------------------------------------------------- counts of a pair
def joined_terms(c: Column) -> Column:
    """Lower-case alphanumeric runs, joined by single blanks."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def _replaced(texts: pa.Array) -> pa.Array:
    """Texts after the replacements of 13a; a line feed that stays is white space anyway."""
    for a, b in B.PRE_REPLACE:
        texts = texts if a == "\n" else pc.replace_substring(texts, a, b)
    return texts


def _pair_udf(want: tuple[str, ...], stemmer: bool):
    names = [c for kind in want for c in COUNTS[kind]]

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in names) + ">")
    def count_pairs(pred: pa.Array, ref: pa.Array) -> pa.Array:
        refs = pc.fill_null(ref.cast(pa.large_string()), "").dictionary_encode()  # a reference once for all its predictions
        n_refs, ref_of = len(refs.dictionary), refs.indices.to_numpy().astype("int64")
        texts = pa.concat_arrays([refs.dictionary, pc.fill_null(pred.cast(pa.large_string()), "")])
        plain = row_13a = np.arange(len(texts))
        if BLEU in want:
            replaced = _replaced(texts)
            changed = pc.not_equal(replaced, texts)
            row_13a = np.where(changed.to_numpy(zero_copy_only=False), len(texts) + np.cumsum(changed) - 1, plain)
            texts = pa.concat_arrays([texts, replaced.filter(changed)])
        words, columns = Words(texts), []

        def pairs(tokens, at) -> Pairs:
            return Pairs((tokens[:at[n_refs]], at[:n_refs + 1]), (tokens[at[n_refs]:], at[n_refs:] - at[n_refs]), ref_of)
        if COSINE in want or ROUGE in want:
            terms, at, distinct = words.tokens(terms_of, plain)
        for kind in want:
            if kind == BLEU:
                p = pairs(*words.tokens(B.tokens_of_word, row_13a)[:2])
                columns += [*p.clipped(ORDERS), *p.lengths()]
            elif kind == COSINE:
                columns += pairs(terms, at).products()
            else:
                p = pairs(renumbered(terms, stems(distinct)) if stemmer else terms, at)
                columns += [p.subsequences(), *p.lengths()]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
    return count_pairs


def example_counts(preds: DataFrame, refs: DataFrame, want: tuple[str, ...] = (BLEU, COSINE), stemmer: bool = True) -> DataFrame:
    """Per (generator, id) what ``want`` asks for: n-gram matches m1..m4, totals t1..t4 and token counts;
    term products; longest common subsequence and term counts. Also the character lengths of both texts.
    A prediction without reference meets an empty one. Texts are joined once, whatever is counted."""
    p = preds.select("generator", "id", F.col("prediction").alias("_p"), F.length("prediction").alias("pred_chars"))
    r = refs.select("id", F.col("reference").alias("_r"), F.length("reference").alias("ref_chars"))
    counted = p.join(r, "id", "left").select("generator", "id", "pred_chars", F.coalesce("ref_chars", F.lit(0)).alias("ref_chars"),
                                             _pair_udf(tuple(want), stemmer)("_p", "_r").alias("c"))
    totals = [F.greatest(F.col("c.sys_len") - n + 1, F.lit(0)).cast("long").alias(f"t{n}") for n in ORDERS] if BLEU in want else []
    return counted.select("generator", "id", "pred_chars", "ref_chars", "c.*", *totals)


def rouge_l_of(counts: DataFrame) -> Column:
    """ROUGE-L F-measure (0-1) from counted pairs: harmonic mean of LCS precision and recall."""
    total = F.col("pred_terms") + F.col("ref_terms")
    return F.when(F.col("lcs") > 0, 2 * F.col("lcs") / total).otherwise(F.lit(0.0))


def tf_cosine_of(counts: DataFrame) -> Column:
    den = F.sqrt(F.col("pp").cast("double")) * F.sqrt(F.col("rr").cast("double"))
    return F.when(den > 0, F.col("dot") / F.when(den > 0, den).otherwise(F.lit(1.0))).otherwise(F.lit(0.0))


def example_scores(counts: DataFrame, limit: int | None = None) -> DataFrame:
    """The per-example table: ``generator, id, bleu`` (sentence BLEU, 0-1), ``tf_cosine, length_ratio``, and
    ``rouge_l`` where it was counted; with ``limit`` the first ids of every generator only."""
    if limit is not None:
        first = Window.partitionBy("generator").orderBy("id")
        counts = counts.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= limit).drop("_k")
    rouge = [rouge_l_of(counts).alias("rouge_l")] if "lcs" in counts.columns else []
    bleu = F.when(F.col("sys_len") == 0, F.lit(0.0)).otherwise(_score(effective_order=True) / F.lit(100.0))
    return counts.select("generator", "id", bleu.alias("bleu"), tf_cosine_of(counts).alias("tf_cosine"),
                         (F.col("pred_chars") / F.greatest("ref_chars", F.lit(1))).alias("length_ratio"), *rouge)


def generator_scores(counts: DataFrame) -> DataFrame:
    """``generator, n, bleu`` (corpus BLEU, 0-100), ``tf_cosine, length_ratio`` and, where it was counted,
    ``rouge_l_f1`` (0-100): one aggregate."""
    rouge = [(F.avg(rouge_l_of(counts)) * 100.0).alias("rouge_l_f1")] if "lcs" in counts.columns else []
    sums = [F.sum(c).alias(c) for c in [f"m{n}" for n in ORDERS] + [f"t{n}" for n in ORDERS] + ["sys_len", "ref_len"]]
    g = counts.groupBy("generator").agg(
        F.count(F.lit(1)).alias("n"), F.avg(tf_cosine_of(counts)).alias("tf_cosine"),
        F.avg(F.col("pred_chars") / F.greatest("ref_chars", F.lit(1))).alias("length_ratio"), *rouge, *sums)
    return g.select("generator", "n", _score().alias("bleu"), "tf_cosine", "length_ratio", *(["rouge_l_f1"] if rouge else []))


# ---------------------------------------------------------------- BLEU
def bleu_stats(preds: DataFrame, refs: DataFrame) -> DataFrame:
    """Per (generator, id): m1..m4, t1..t4, sys_len, ref_len."""
    cols = [f"m{n}" for n in ORDERS] + [f"t{n}" for n in ORDERS]
    return example_counts(preds, refs, (BLEU,)).select("generator", "id", *cols, "sys_len", "ref_len")


def _score(prefix: str = "", effective_order: bool = False) -> Column:
    m = [F.col(f"{prefix}m{n}") for n in ORDERS]
    t = [F.col(f"{prefix}t{n}") for n in ORDERS]
    return B.bleu_score(m, t, F.col(f"{prefix}sys_len"), F.col(f"{prefix}ref_len"), effective_order)


def corpus_bleu(stats: DataFrame) -> DataFrame:
    """(generator, bleu) with counts summed over the corpus (0-100)."""
    sums = [F.sum(c).alias(c) for c in [f"m{n}" for n in ORDERS] + [f"t{n}" for n in ORDERS]
            + ["sys_len", "ref_len"]]
    g = stats.groupBy("generator").agg(*sums)
    return g.select("generator", _score().alias("bleu"))


def sentence_bleu(stats: DataFrame, zero_if_empty: bool = True) -> DataFrame:
    """(generator, id, bleu) per row: effective order, scaled to 0-1."""
    s = _score(effective_order=True) / F.lit(100.0)
    if zero_if_empty:
        s = F.when(F.col("sys_len") == 0, F.lit(0.0)).otherwise(s)
    return stats.select("generator", "id", s.alias("bleu"))


# ---------------------------------------------------------------- ROUGE-L
def rouge_l(pairs: DataFrame, use_stemmer: bool = True) -> DataFrame:
    """(generator, id, rouge_l) F-measure in 0-1 from (generator, id, reference, prediction)."""
    counts = pairs.select("generator", "id", _pair_udf((ROUGE,), use_stemmer)("prediction", "reference").alias("c")).select("generator", "id", "c.*")
    return counts.select("generator", "id", rouge_l_of(counts).alias("rouge_l"))


# ---------------------------------------------------------------- cosine & ratio
def cosine(a: Column, b: Column) -> Column:
    """Cosine of two equal-length numeric arrays; 0 when a norm is 0."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda s, x: s + x * x))
    den = na * nb
    return F.when(den > 0, dot / F.when(den > 0, den).otherwise(F.lit(1.0))).otherwise(F.lit(0.0))


def tf_cosine(preds: DataFrame, refs: DataFrame) -> DataFrame:
    """(generator, id, cosine) between term-frequency vectors of prediction and reference."""
    counts = example_counts(preds, refs, (COSINE,))
    return counts.select("generator", "id", tf_cosine_of(counts).alias("cosine"))


def embedding_cosine(preds: DataFrame, refs: DataFrame, model: Model) -> DataFrame:
    """(generator, id, cosine) between embeddings of prediction and reference; every reference is
    embedded once. Null where the model failed on either text."""
    p = embed(preds, "prediction", model, "_pv").select("generator", "id", "_pv")
    r = embed(refs, "reference", model, "_rv").select("id", "_rv")
    as_double = lambda c: F.transform(c, lambda x: x.cast("double"))
    return p.join(r, "id").select("generator", "id", cosine(as_double("_pv"), as_double("_rv")).alias("cosine"))


def length_ratio(pred: Column, ref: Column) -> Column:
    return F.length(pred) / F.greatest(F.length(ref), F.lit(1))
