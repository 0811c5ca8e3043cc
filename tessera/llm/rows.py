"""Small helpers on frames of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Bits of the bitmaps that tell which texts need a join (a megabyte).
FILTER_BITS = 1 << 23


def id_key(doc_id: str) -> Column:
    """The id as text; a null id is one more id."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def row_key(doc_id: str, text: str) -> list[Column]:
    """Two never-null columns that tell rows apart by id and text."""
    return [id_key(doc_id).alias("__id"), F.xxhash64(text).alias("__text")]


def id_bitmap(found: DataFrame) -> DataFrame:
    """``__bucket, __bitmap`` of the hashed ``__id``: at most ``FILTER_BITS / 32768`` rows of 4 KB."""
    at = F.pmod(F.xxhash64("__id"), F.lit(FILTER_BITS))
    return (found.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("__bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bitmap")))


def split_by_bitmap(rows: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``__id`` may be in ``found``, and rows whose id certainly is not: those need no join.

    ``found`` must be a written table, as it is read here and for the join.
    """
    at = F.pmod(F.xxhash64("__id"), F.lit(FILTER_BITS))
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bitmap", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = (rows.withColumn("__bucket", F.bitmap_bucket_number(at)).join(F.broadcast(id_bitmap(found)), "__bucket", "left")
              .withColumn("__may", F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))).drop("__bucket", "__bitmap"))
    return marked.where("__may").drop("__may"), marked.where("not __may").drop("__may")


def keep_times(docs: DataFrame, verdict: DataFrame, times: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` as often as ``verdict`` (``doc_id, text_hash`` and ``times`` of every row)
    says, with the columns of ``docs``. Rows that repeat id and text stay as often as their times sum to.

    Only texts whose row goes, or repeats, are joined; the others pass the join by.
    """
    changed = cut_lineage(
        verdict.groupBy(id_key("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
        .agg(F.count(F.lit(1)).alias("__rows"), F.sum(F.col(times).cast("long")).alias("__times")).where("__rows > 1 or __times <> 1"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), *row_key(doc_id, text))
    maybe, others = split_by_bitmap(keyed, changed)
    first = Window.partitionBy("__id", "__text").orderBy("__times")
    joined = maybe.join(changed, ["__id", "__text"], "left").withColumn("__n", F.row_number().over(first))
    often = F.when(F.col("__times").isNull(), 1).when(F.col("__n") == 1, F.col("__times")).otherwise(0)
    kept = joined.withColumn("__often", often).where("__often > 0").select("row", F.explode(F.expr("sequence(1L, __often)")))
    return kept.select("row.*").unionByName(others.select("row.*"))


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of consecutive rows with equal ``keys``, across batch borders; rows must be sorted by them."""
    pending: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        head = tuple(c[0] for c in columns)
        if pending and head != last:
            yield pa.Table.from_batches(pending)
            pending = []
        starts = [0, *np.flatnonzero(change).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield pa.Table.from_batches([*pending, batch.slice(a, b - a)])
            pending = []
        pending.append(batch.slice(starts[-1]))
        last = tuple(c[-1] for c in columns)
    if pending:
        yield pa.Table.from_batches(pending)
