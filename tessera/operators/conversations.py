"""Chat-turn tables -> per-conversation training text.

Each turn is rendered in its own row first (a projection inside codegen);
only the rendered segments are gathered per conversation and joined in turn
order. The gathered size is the conversation's own text, which is the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dataset import turn_segment


def conversation_segments(conv: DataFrame, marker: str = "<|{role}|>", end: str = "<|end|>") -> DataFrame:
    """Long form: one rendered segment per (conv_id, turn)."""
    return conv.select("conv_id", "turn", turn_segment(F.col("role"), F.col("text"), marker, end).alias("segment"))


def conversation_text(conv: DataFrame, marker: str = "<|{role}|>", end: str = "<|end|>") -> DataFrame:
    seg = conversation_segments(conv, marker, end)
    g = seg.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("turn", "segment"))).alias("_s"))
    return g.select("conv_id", "n_turns", F.array_join(F.transform("_s", lambda x: x["segment"]), "").alias("text"))
