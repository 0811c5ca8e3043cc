"""Structured Streaming twin of the incremental sync.

A file source (new change files land in ``source_dir``) is consumed with
``trigger(availableNow=True)``: every pending file is processed, then the
query stops - the streaming form of a timer-driven catch-up run. Each
micro-batch is merged newest-row-wins into the touched buckets of a versioned
table. The merge is idempotent, so a batch replayed after a failure between
write and checkpoint commit, or another feed with batch ids of its own, can
neither apply twice nor be skipped. The checkpoint replaces the watermark file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.operators.sync import VersionedTable, dedupe_changes, upsert_newest_versioned


def sync_stream(spark: SparkSession, source_dir: str, schema: T.StructType, target: VersionedTable,
                order: Sequence[str], checkpoint: str,
                max_files_per_trigger: int = 1, fmt: str = "parquet") -> DataFrame:
    stream = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(source_dir))

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        upsert_newest_versioned(target, dedupe_changes(batch, target.pk, order), order)

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target.read()
