"""Column-expression text functions (JVM side, whole-stage codegen).

Every function takes and returns ``Column`` objects so callers compose them
inside ``select``/``withColumn`` and Catalyst keeps them in one codegen span.
The regular expressions are written once here and reused by the DuckDB
oracle strings in ``tessera.plans.sqlfrag`` (Java and RE2 accept the same
``\\x{..}`` escapes), which is what keeps the two engines token-identical.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
# Python's Unicode whitespace (what ``str.split()`` / ``\s`` match), spelled
# out so Java and RE2 agree: TAB LF VT FF CR, FS GS RS US, SPACE, NEL, NBSP,
# OGHAM SPACE MARK, EN QUAD..HAIR SPACE, LINE SEP, PARAGRAPH SEP, NARROW NBSP,
# MEDIUM MATH SPACE, IDEOGRAPHIC SPACE.
WS_CLASS = ("\\t\\n\\x{0b}\\x{0c}\\r\\x{1c}-\\x{1f} \\x{85}\\x{a0}\\x{1680}"
            "\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}")
WS_RUN = f"[{WS_CLASS}]+"
# HTML tag as the reference strips it.
HTML_TAG = "<[^>]+>"
# Word tokenizer of the character language models: split on whitespace and
# the punctuation - / & , ( ) + . '  and keep only tokens of 2+ ASCII letters.
WORD_SPLIT = f"[{WS_CLASS}\\-/&,()+.']+"
WORD_KEEP = "^[a-z]{2,}$"
# Sentence boundary used by the text chunker: after . ! ? followed by space.
SENTENCE_END = "(?<=[.!?])[" + WS_CLASS + "]+"


def nullif_empty(c: Column) -> Column:
    return F.when(c != F.lit(""), c)


def clean_text(c: Column) -> Column:
    """Strip HTML tags, collapse Unicode whitespace, trim; empty -> NULL."""
    stripped = F.regexp_replace(c, HTML_TAG, " ")
    collapsed = F.trim(F.regexp_replace(stripped, WS_RUN, " "))
    return nullif_empty(collapsed)


def coerce_double(c: Column) -> Column:
    """Tolerant float coercion: unparsable or NaN -> NULL (ANSI-safe)."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def char_count(c: Column) -> Column:
    return F.length(c)


def word_count(c: Column) -> Column:
    """Whitespace-separated words (Python ``len(s.split())``)."""
    return F.size(F.filter(F.split(c, WS_RUN), lambda x: x != F.lit("")))


def tokenize_words(c: Column) -> Column:
    """ARRAY<STRING> of lower-case ``[a-z]{2,}`` tokens in text order."""
    parts = F.split(F.lower(c), WORD_SPLIT)
    return F.filter(parts, lambda x: x.rlike(WORD_KEEP))


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


def split_sentences(c: Column) -> Column:
    """Sentences: split after ``.!?`` + whitespace; empty pieces dropped."""
    t = F.regexp_replace(F.regexp_replace(c, f"^{WS_RUN}", ""), f"{WS_RUN}$", "")
    return F.filter(F.split(t, SENTENCE_END), lambda x: x != F.lit(""))


def chunk_text(c: Column, max_chars: int = 180) -> Column:
    """Greedy packing of sentences into chunks of at most ``max_chars``.

    A fold over the sentence array; a sentence longer than ``max_chars``
    stays whole as its own chunk. Returns ARRAY<STRING>.
    """
    sents = split_sentences(c)
    init = F.struct(F.array().cast("array<string>").alias("chunks"), F.lit("").alias("buf"))

    def step(acc, s):
        fits = F.length(acc["buf"]) + 1 + F.length(s) <= F.lit(max_chars)
        joined = F.trim(F.concat(acc["buf"], F.lit(" "), s))
        pushed = F.when(acc["buf"] != F.lit(""), F.array_append(acc["chunks"], acc["buf"])) \
            .otherwise(acc["chunks"])
        return F.when(fits, F.struct(acc["chunks"].alias("chunks"), joined.alias("buf"))) \
            .otherwise(F.struct(pushed.alias("chunks"), s.alias("buf")))

    def finish(acc):
        return F.when(acc["buf"] != F.lit(""), F.array_append(acc["chunks"], acc["buf"])) \
            .otherwise(acc["chunks"])

    return F.aggregate(sents, init, step, finish)


def metadata_json(cols: dict[str, Column]) -> Column:
    """Per-row JSON object of side attributes with explicit nulls."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in cols.items()]), {"ignoreNullFields": "false"})
