"""BLEU tokenization (the standard ``13a`` scheme) and the score formula as Columns.

Definitions follow Papineni et al. (2002) with the ``exp`` smoothing and the
``13a`` tokenizer of Post (2018). Everything is JVM-side expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import WS_RUN

# ---------------------------------------------------------------------------
# 13a preprocessing and regex cascade, in application order.
# ---------------------------------------------------------------------------
PRE_REPLACE = (("<skipped>", ""), ("-\n", ""), ("\n", " "),
               ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
RULES = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" {1} "),   # space out ASCII symbols
    (r"([^0-9])([\.,])", r"{1} {2} "),              # period/comma not after a digit
    (r"([\.,])([^0-9])", r" {1} {2}"),              # period/comma not before a digit
    (r"([0-9])(-)", r"{1} {2} "),                   # dash after a digit
)
MAX_ORDER = 4


def text_13a(c: Column) -> Column:
    """The 13a tokens joined by single spaces (``''`` when there are none)."""
    s = c
    for a, b in PRE_REPLACE:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in RULES:
        s = F.regexp_replace(s, pat, rep.format("", "$1", "$2"))
    return F.trim(F.regexp_replace(s, WS_RUN, " "))


# a word has no blanks: the first rule leaves out the one in its range
_IN_WORD = [(re.compile(pat.replace(r"\` -\&", r"\`!-\&")), rep.format("", r"\1", r"\2")) for pat, rep in RULES]
# symbols that leave the end of any word
_AT_END = frozenset(".,!?:;)]}\"")


def tokens_of_word(word: str) -> list[str]:
    """13a tokens of a word of replaced text: no rule sees beyond the white space around it."""
    if word.isalnum():
        return [word]
    if word[-1:] in _AT_END and word[:-1].isalnum():
        return [word[:-1], word[-1]]
    s = f" {word} "
    for pat, rep in _IN_WORD:
        s = pat.sub(rep, s)
    return s.split()


def bleu_score(m: list[Column], t: list[Column], sys_len: Column, ref_len: Column,
               effective_order: bool = False) -> Column:
    """BLEU (0-100) from matched/total n-gram counts with ``exp`` smoothing.

    Mirrors the standard computation: zero matches -> 0; smoothing halves
    the zero precisions in order; a zero total stops the orders (corpus mode
    scores 0 then, effective-order mode averages the active orders only).
    """
    bp = F.when(sys_len < ref_len,
                F.when(sys_len > 0, F.exp(F.lit(1.0) - ref_len / F.greatest(sys_len, F.lit(1)))).otherwise(F.lit(0.0))) \
          .otherwise(F.lit(1.0))
    active = [t[i] > 0 for i in range(MAX_ORDER)]
    # orders are active as a prefix (totals never increase with n)
    prefix = []
    acc = F.lit(True)
    for a in active:
        acc = acc & a
        prefix.append(acc)
    k = F.lit(0)
    logs = []
    for i in range(MAX_ORDER):
        zero = prefix[i] & (m[i] == 0)
        k = k + zero.cast("int")
        ts = F.greatest(t[i], F.lit(1))  # inactive orders are masked below
        p = F.when(m[i] == 0, F.lit(100.0) / (F.pow(F.lit(2.0), k) * ts)) \
             .otherwise(F.lit(100.0) * m[i] / ts)
        logs.append(F.when(prefix[i], F.log(p)).otherwise(F.lit(-9999999999.0)))
    n_active = sum((p.cast("int") for p in prefix), F.lit(0))
    total = logs[0] + logs[1] + logs[2] + logs[3]
    if effective_order:
        eff_total = logs[0]
        for i in range(1, MAX_ORDER):
            eff_total = eff_total + F.when(prefix[i], logs[i]).otherwise(F.lit(0.0))
        mean_log = F.when(n_active > 0, eff_total / n_active).otherwise(total / MAX_ORDER)
    else:
        mean_log = total / MAX_ORDER
    any_match = (m[0] + m[1] + m[2] + m[3]) > 0
    return F.when(~any_match, F.lit(0.0)).otherwise(bp * F.exp(mean_log))
