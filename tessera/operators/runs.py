"""Training-run metric logs: split by row kind, last-line-wins per step, side-by-side runs.

A metric log mixes train, eval and summary rows in one JSON-lines file;
``tessera.sources.files.read_metric_log`` tags each row with its kind and its
line number. When a step appears twice (two overlapping runs appending to
one file) the *last line* wins, which is a ``max_by`` over ``line_no`` - no
sort of the log is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import align

SUMMARY_KEYS = ("train_runtime", "train_samples_per_second", "train_steps_per_second", "total_flos", "train_loss")
EVAL_KEYS = ("eval_loss", "eval_mean_token_accuracy")


def last_by_step(log: DataFrame, kind: str, cols: Sequence[str]) -> DataFrame:
    """(step, cols...) of the given kind; the last line per step wins."""
    rows = log.where(F.col("kind") == kind)
    g = rows.groupBy("step").agg(F.max_by(F.struct(*cols), F.col("line_no")).alias("_v"))
    return g.select("step", *[F.col("_v")[c].alias(c) for c in cols])


def summary(log: DataFrame, keys: Sequence[str] = SUMMARY_KEYS) -> DataFrame:
    """Last summary row, unpivoted to (metric, value)."""
    s = log.where(F.col("kind") == "summary").agg(F.max_by(F.struct(*keys), F.col("line_no")).alias("_v"))
    stack = ", ".join(f"'{k}', CAST(_v.{k} AS DOUBLE)" for k in keys)
    return s.selectExpr(f"stack({len(keys)}, {stack}) AS (metric, value)")


def compare_eval(a: DataFrame, b: DataFrame, keys: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """Eval metrics of two runs aligned on step (full outer: a step of one run only shows NULL)."""
    return align(last_by_step(a, "eval", keys), last_by_step(b, "eval", keys), "step", ("_a", "_b"))


def compare_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    return summary(a).withColumnRenamed("value", "value_a").join(
        summary(b).withColumnRenamed("value", "value_b"), "metric", "full_outer")


def final_eval(log: DataFrame, keys: Sequence[str] = EVAL_KEYS) -> DataFrame:
    """The last eval row of the log, whatever its step: a run appended later ends the log."""
    e = log.where(F.col("kind") == "eval")
    return e.agg(F.max_by(F.struct("step", *keys), F.col("line_no")).alias("_v")).select("_v.*")


def fmt4g(x) -> str:
    """Number as ``%.4g``; missing as ``-`` (used when rendering a few collected rows)."""
    return "-" if x is None else f"{x:.4g}"


def render_eval_table(cmp: DataFrame, keys: Sequence[str] = EVAL_KEYS) -> str:
    """Markdown table of the aligned eval metrics (the frame has one row per eval step)."""
    rows = cmp.orderBy("step").collect()
    head = "| step | " + " | ".join(f"A {k} | B {k}" for k in keys) + " |"
    out = [head, "|" + "---|" * (1 + 2 * len(keys))]
    for r in rows:
        cells = [str(r["step"])] + [fmt4g(r[f"{k}{s}"]) for k in keys for s in ("_a", "_b")]
        out.append("| " + " | ".join(cells) + " |")
    return "\n".join(out)
