"""Language identification by words first, then shorter and shorter n-grams.

A word seen in training scores by its log frequency in each language. A word
not seen backs off to its character n-grams of the longest order of which any
is known, and scores by their mean log frequency. A text's score is the sum
over its words; the answer is the best language with its posterior probability.

Training is a Spark aggregation over a bounded sample of labelled rows: at most
about ``max_train_chars`` characters per language, in blocks of texts chosen by a hash,
so the fitted tables have a bound that does not depend on the corpus and may be
broadcast. Prediction is a row-wise Arrow UDF over every whole text.

Defined results: null text, empty text or text without a letter gives ``und``
with score 0; rows with null text or label do not train; a label seen in no
training row is never predicted; with no training rows everything is ``und``;
more than ``MAX_LANGUAGES`` labels are an error.
Only the text and label columns are read, so other columns cannot clash. Ties go
to the language first by code point.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
MAX_TRAIN_CHARS = 1_000_000
MAX_ORDER = 5
MIN_COUNT = 2
#: Unseen words whose scores a worker remembers, and the bytes of these scores.
MEMO_WORDS, MEMO_BYTES = 3 << 16, 1 << 25

WORD = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class LanguageModel:
    """Log frequencies by word and by n-gram, one row of ``table`` per entry."""

    languages: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]  # by order, from 1
    table: np.ndarray
    memo: dict[str, int] = field(default_factory=dict)  # unseen word -> row of ``scores``
    scores: np.ndarray | None = None

    def backed_off(self, word: str) -> np.ndarray:
        """Score of an unseen word from its longest known n-grams."""
        padded = f" {word} "
        for n in range(min(len(self.grams), len(padded)), 0, -1):
            known = self.grams[n - 1].get
            at = [i for i in [known(padded[k:k + n]) for k in range(len(padded) - n + 1)] if i is not None]
            if at:
                return self.table[at].sum(axis=0) / len(at)
        return np.zeros(len(self.languages))

    def unseen(self, words: list[str]) -> np.ndarray:
        """Sum of the scores of unseen words; those met before are looked up together."""
        if self.scores is None:
            self.scores = np.empty((max(1, min(MEMO_WORDS, MEMO_BYTES // (8 * len(self.languages)))), len(self.languages)))
        total, rows = np.zeros(len(self.languages)), []
        for w in words:
            i = self.memo.get(w)
            if i is None:
                if len(self.memo) >= len(self.scores):
                    total += self.scores[rows].sum(axis=0)
                    rows = []
                    self.memo.clear()
                i = self.memo[w] = len(self.memo)
                self.scores[i] = self.backed_off(w)
            rows.append(i)
        return total + self.scores[rows].sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        words = words_of(text)
        known = [self.words.get(w, -1) for w in words]
        at = np.array(known, np.int64)
        score = self.table[at[at >= 0]].sum(axis=0)
        if at.size and at.min() < 0:
            score = score + self.unseen([w for w, i in zip(words, known) if i < 0])
        odds = np.exp(score - score.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


#: Characters of a block; texts are sampled by blocks, so a few long ones are not drawn or left as wholes.
BLOCK_CHARS = 1024


def training_sample(rows: DataFrame, text: str, lang: str, max_chars: int) -> DataFrame:
    """Blocks of labelled texts, per language thinned by hash to about ``max_chars`` characters. Copies of a
    text count, and enter, once; a language with fewer characters enters whole."""
    rows = (rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
            .withColumn("hash", F.xxhash64("text")))
    distinct = rows.groupBy("lang", "hash").agg(F.max(F.length("text")).alias("n"))
    share = distinct.groupBy("lang").agg(F.sum(F.col("n").cast("double")).alias("chars"))
    span = 1 << 30
    chosen = F.filter(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("text") / BLOCK_CHARS).cast("int") - 1)),
                      lambda i: F.pmod(F.xxhash64("hash", i), F.lit(span)) * F.col("chars") < F.lit(float(max_chars) * span))
    blocks = rows.join(F.broadcast(share.limit(MAX_LANGUAGES)), "lang").select("lang", "hash", "text", F.explode(chosen).alias("block"))
    part = F.substring("text", F.col("block") * BLOCK_CHARS + 1, F.lit(BLOCK_CHARS))
    return blocks.select("lang", "hash", "block", part.alias("text")).groupBy("lang", "hash", "block").agg(F.first("text").alias("text")).select("lang", "text")


#: Languages beyond this many are an error, not a silent cut: see ``fit``.
MAX_LANGUAGES = 1000


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", max_train_chars: int = MAX_TRAIN_CHARS,
        max_order: int = MAX_ORDER, min_count: int = MIN_COUNT) -> LanguageModel:
    """Count words and n-grams of the labelled rows and turn them into log frequencies."""
    n_languages = rows.select(lang).distinct().limit(MAX_LANGUAGES + 1).count()
    if n_languages > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels in {lang}")
    sample = training_sample(rows, text, lang, max_train_chars)
    words = (sample.select("lang", F.explode(words_udf()("text")).alias("w")).select("lang", "w.word", "w.n")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    counts = words.toPandas()
    languages = sorted(counts["lang"].unique())
    column = {x: i for i, x in enumerate(languages)}
    by_word: dict[str, np.ndarray] = {}
    by_gram: list[dict[str, np.ndarray]] = [{} for _ in range(max_order)]

    def add(to, key, at, n):
        row = to.get(key)
        if row is None:
            row = to[key] = np.zeros(len(languages))
        row[at] += n

    for name, word, n in counts.itertuples(index=False):
        at = column[name]
        add(by_word, word, at, n)
        padded = f" {word} "
        for order in range(1, max_order + 1):
            for k in range(len(padded) - order + 1):
                add(by_gram[order - 1], padded[k:k + order], at, n)
    parts, start, tables = [], 0, []
    for kept in [{k: v for k, v in by_word.items() if v.sum() >= min_count}, *by_gram]:
        parts.append({k: start + i for i, k in enumerate(sorted(kept))})
        start += len(kept)
        if kept:
            seen = np.array([kept[k] for k in sorted(kept)])
            tables.append(np.log((seen + 0.5) / (seen.sum(axis=0) + 0.5 * len(kept))))
    table = np.concatenate(tables) if tables else np.zeros((0, len(languages)))
    return LanguageModel(languages, parts[0], parts[1:], table)


def words_udf():
    @F.arrow_udf("array<struct<word:string,n:long>>")
    def count_words(texts: pa.Array) -> pa.Array:
        """Words of each text with their counts: repeats collapse before they leave the worker."""
        words, n, ends = [], [], [0]
        for t in texts.to_pylist():
            seen: dict[str, int] = {}
            for w in words_of(t or ""):
                seen[w] = seen.get(w, 0) + 1
            words += seen
            n += seen.values()
            ends.append(len(words))
        pairs = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
    return count_words


def predict(spark, model: LanguageModel, text: Column | str) -> Column:
    """``struct<lang_pred, score>`` of each whole text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict_texts(texts: pa.Array) -> pa.Array:
        m = shared.value
        found = [m.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
            ["lang_pred", "score"])
    return predict_texts(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text divisible by 5; null ids never train either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(~held_out(doc_id))
