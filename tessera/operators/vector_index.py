"""Approximate nearest neighbours: coarse centroids with inverted lists, beside the exact search.

Building: centroids are fitted on a bounded, hash-chosen sample (``SAMPLE_ROWS``); every row is
assigned to its nearest centroid and written, with the rows of its list, in packed blocks
of unit vectors. A list is dealt in parts of about ``PART_ROWS`` rows, so a list that holds a
third of all rows is many tasks' work. Searching: a query goes to its ``probes`` nearest
lists and meets their parts in a join by list; within a part all rows are scored exactly. So the
only thing that is approximate is which lists a query sees: with as many probes as lists the
result is the exact one. ``tuned_probes`` takes the fewest probes that reach a recall on
a sample of queries whose exact neighbours are known.

Centroids (at most ``MAX_LISTS`` of them) are the only thing that is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import vectors as V

#: Rows that centroids are fitted on, at most; lists, at most; rows of a part of a list, about.
SAMPLE_ROWS = 50_000
MAX_LISTS = 4096
PART_ROWS = 1 << 16


@dataclass(frozen=True)
class VectorIndex:
    """A written index: its folder, centroids (unit rows) and the type of its ids."""

    path: str
    centroids: np.ndarray
    id_sql: str
    id_type: pa.DataType

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/blocks")


def coarse_centroids(rows: DataFrame, id_col: str, vec: str, lists: int, n_rows: int, seed: int = 7) -> np.ndarray:
    """Centroids of a sample of at most about ``SAMPLE_ROWS`` rows, chosen by a hash of the id."""
    span = 1 << 30
    usable = F.exists(vec, lambda x: x != 0)
    sample = rows.where(F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(span)) < min(1.0, SAMPLE_ROWS / max(n_rows, 1)) * span).where(usable)
    features = sample.select(array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    model = KMeans(k=lists, maxIter=8, seed=seed, distanceMeasure="cosine").fit(features)
    found = np.array(model.clusterCenters())
    return found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-300)


def with_lists(rows: DataFrame, id_col: str, vec: str, centroids: np.ndarray, probes: int) -> DataFrame:
    """``id, vec, rank, list`` of the ``probes`` nearest centroids of every row with a vector, nearest first (rank 0)."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    id_sql, vec_sql = dict(rows.dtypes)[id_col], dict(rows.dtypes)[vec]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = V.unit_vectors(batch.column("vec")) @ shared.value.T
            chosen = np.argsort(-sims, axis=1, kind="stable")[:, :probes].astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, chosen.size + 1, chosen.shape[1]), pa.int32()), pa.array(chosen.ravel()))
            yield pa.record_batch({"id": batch.column("id"), "vec": batch.column("vec"), "lists": lists})

    chosen = rows.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec).alias("vec"))
    return chosen.mapInArrow(assign, f"id {id_sql}, vec {vec_sql}, lists array<long>").select("id", "vec", F.posexplode("lists").alias("rank", "list"))


def build(rows: DataFrame, id_col: str, vec: str, path: str, lists: int | None = None) -> VectorIndex:
    """Index every row of ``rows`` under ``path``. ``lists``: the square root of the rows, unless given."""
    n = rows.count()
    k = max(1, min(lists or round(n ** 0.5), MAX_LISTS, n))
    centroids = coarse_centroids(rows, id_col, vec, k, n)
    with_lists(rows, id_col, vec, centroids, 1).drop("rank").write.parquet(f"{path}/assigned")
    assigned = rows.sparkSession.read.parquet(f"{path}/assigned")
    sizes = assigned.groupBy("list").agg(F.count(F.lit(1)).alias("size"))  # a row per list, at most MAX_LISTS
    parts = F.ceil(F.col("size") / PART_ROWS).cast("long")
    key = (F.col("list") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("part")
    dealt = assigned.join(F.broadcast(sizes.select("list", parts.alias("parts"))), "list").select("id", "vec", key).repartition("part").sortWithinPartitions("part")
    V.packed(dealt, "id", "vec", by="part").withColumn("list", F.shiftright("part", 32)).write.parquet(f"{path}/blocks")
    return VectorIndex(path, centroids, dict(rows.dtypes)[id_col], V.arrow_type(rows, id_col))


def search(index: VectorIndex, queries: DataFrame, query_id: str, query_vec: str, k: int, probes: int) -> DataFrame:
    """(query_id, cand_id, score, rank): the best ``k`` rows of the ``probes`` lists nearest to each query."""
    spark = queries.sparkSession
    blocks = index.blocks(spark)
    probed = with_lists(queries, query_id, query_vec, index.centroids, min(probes, len(index.centroids)))
    parts = blocks.select("list", "part").distinct()
    asked = probed.join(parts, "list").select("id", "vec", "part").repartition("part").sortWithinPartitions("part")
    asked = V.packed(asked, "id", "vec", by="part").withColumnRenamed("part", "group")
    query_sql = dict(queries.dtypes)[query_id]
    dealt = V.dealt_blocks(blocks.withColumnRenamed("part", "group"), asked, query_sql, index.id_sql)
    found = V.best_by_group(dealt, k, V.arrow_type(queries, query_id), index.id_type, query_sql, index.id_sql)
    return V.ranked(found, k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact ``query_id, cand_id`` pairs that were found."""
    pairs = exact.select("query_id", "cand_id", F.lit(1).alias("wanted")).join(
        found.select("query_id", "cand_id", F.lit(1).alias("got")), ["query_id", "cand_id"], "left")
    r = pairs.agg(F.count("wanted").alias("wanted"), F.count("got").alias("got")).first()
    return r["got"] / r["wanted"] if r["wanted"] else 1.0


def tuned_probes(index: VectorIndex, sample: DataFrame, query_id: str, query_vec: str, exact: DataFrame, target: float) -> int:
    """The fewest probes whose recall on ``sample`` reaches ``target``, given the sample's exact ``query_id, cand_id``.

    A neighbour is found exactly when its list is probed, as lists are searched exactly. So one pass that
    ranks the neighbours' lists by their nearness to the query gives the recall of every number of probes.
    """
    lists = with_lists(sample, query_id, query_vec, index.centroids, len(index.centroids)).select(F.col("id").alias("query_id"), "list", "rank")
    held = sample.sparkSession.read.parquet(f"{index.path}/assigned").select(F.col("id").alias("cand_id"), "list")
    ranks = exact.select("query_id", "cand_id").join(held, "cand_id").join(lists, ["query_id", "list"])
    counts = sorted((r["rank"], r["count"]) for r in ranks.groupBy("rank").count().collect())  # at most a row per list
    total, reached = sum(n for _, n in counts), 0
    for rank, n in counts:
        reached += n
        if reached >= target * total:
            return rank + 1
    return len(index.centroids)
