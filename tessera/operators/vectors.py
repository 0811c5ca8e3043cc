"""Vector columns: cosine, centroids, exact top-k nearest neighbours.

Exact k-NN never materialises (query, candidate) pairs. Candidates are packed into
blocks and dealt to groups that a task can hold; packed queries go to every group and
stream past it, one matrix product a block, and only a query's best of the group leave the
task. A final ``row_number`` over ``partition by query`` keeps the best of all groups.
What moves is the candidates once and the queries as often as there are groups; nothing
passes the driver but the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

#: Vectors of a packed block, and blocks of candidates that a task holds at once.
BLOCK_ROWS = 1024
GROUP_BLOCKS = 64


def centroids(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Per-key mean vector: posexplode -> avg per (key, dim) -> array in dim order."""
    e = df.select(key, F.posexplode(vec).alias("dim", "x"))
    g = e.groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return g.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("_c")) \
            .select(key, F.transform("_c", lambda s: s["x"]).alias("centroid"))


def unit_vectors(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of length one; a vector of zeros stays."""
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    norm = np.sqrt(np.square(m).sum(axis=1, keepdims=True))
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return df.select(column).limit(0).toArrow().schema.field(column).type


def packed(df: DataFrame, id_col: str, vec: str, by: str | None = None) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` unit vectors: ``block, n, ids, units`` and ``by``, whose equal
    values must follow each other in a partition. Rows without a vector take no part."""
    id_type, id_sql = arrow_type(df, id_col), dict(df.dtypes)[id_col]
    schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("ids", pa.list_(id_type)), ("units", pa.binary()), *([(by, pa.int64())] if by else [])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = unit_vectors(batch.column("vec"))
            key = batch.column("by").to_numpy() if by else np.zeros(batch.num_rows, np.int64)
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if batch.num_rows else []
            cuts = [c for a, b in zip(heads, [*heads[1:], batch.num_rows]) for c in range(int(a), int(b), BLOCK_ROWS)]
            ends = {c: min(c + BLOCK_ROWS, int(heads[np.searchsorted(heads, c, side="right")]) if c < heads[-1] else batch.num_rows) for c in cuts}
            yield pa.RecordBatch.from_pylist(
                [{"block": c, "n": e - c, "ids": batch.column("id").slice(c, e - c).to_pylist(), "units": units[c:e].tobytes(),
                  **({by: int(key[c])} if by else {})} for c, e in ends.items()], schema)

    rows = df.where(F.col(vec).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec).alias("vec"), *([F.col(by).cast("long").alias("by")] if by else []))
    blocks = rows.mapInArrow(pack, f"block long, n int, ids array<{id_sql}>, units binary" + (f", {by} long" if by else ""))
    return blocks.withColumn("block", F.monotonically_increasing_id())


def best_of_group(queries: dict, k: int, units: np.ndarray, ids: list) -> Iterator[dict]:
    """The first ``k`` candidates of a group, in id order, for every query of a block."""
    q = np.frombuffer(queries["units"]).reshape(queries["n"], -1)
    best = None
    for s in range(0, len(ids), BLOCK_ROWS):
        sims = q @ units[s:s + BLOCK_ROWS].T
        kth = np.partition(sims, -k, axis=1)[:, -k] if sims.shape[1] > k else np.full(len(sims), -np.inf)
        a, c = np.nonzero(sims >= kth[:, None])
        entry = np.stack([a, c + s]), sims[a, c]
        if best is not None:
            entry = np.concatenate([best[0], entry[0]], axis=1), np.concatenate([best[1], entry[1]])
        by = np.lexsort((entry[0][1], -entry[1], entry[0][0]))
        row = entry[0][0][by]
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        rank = np.arange(len(row)) - np.repeat(start, np.diff(start, append=len(row)))
        by = by[rank < k]
        best = entry[0][:, by], entry[1][by]
    if best is not None:
        for a, c, score in zip(best[0][0].tolist(), best[0][1].tolist(), best[1].tolist()):
            yield {"query_id": queries["ids"][a], "cand_id": ids[c], "score": score}


def best_by_group(dealt: DataFrame, k: int, query_type: pa.DataType, cand_type: pa.DataType, query_sql: str, cand_sql: str) -> DataFrame:
    """Local best of rows sorted by ``group`` and ``is_query``: blocks of candidates, then blocks of queries."""
    schema = pa.schema({"query_id": query_type, "cand_id": cand_type, "score": pa.float64()})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, ready = None, [], None
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    group, held, ready = row["group"], [], None
                if not row["is_query"]:
                    held.append(row)
                    continue
                if not held:
                    continue
                if ready is None:
                    ids = [x for r in held for x in r["ids"]]
                    units = np.concatenate([np.frombuffer(r["units"]).reshape(r["n"], -1) for r in held])
                    order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0)))
                    ready = units[order], [ids[i] for i in order.tolist()]
                row["ids"] = row["query_ids"]
                found = list(best_of_group(row, k, *ready))
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema)

    return dealt.mapInArrow(meet, f"query_id {query_sql}, cand_id {cand_sql}, score double")


def dealt_blocks(candidates: DataFrame, queries: DataFrame, query_sql: str, cand_sql: str) -> DataFrame:
    """Candidate and query blocks that have a ``group``, together and in order."""
    c = candidates.select("group", F.lit(False).alias("is_query"), "n", "ids", F.lit(None).cast(f"array<{query_sql}>").alias("query_ids"), "units")
    q = queries.select("group", F.lit(True).alias("is_query"), "n", F.lit(None).cast(f"array<{cand_sql}>").alias("ids"), F.col("ids").alias("query_ids"), "units")
    return c.unionByName(q).repartition("group").sortWithinPartitions("group", "is_query")


def ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("cand_id"))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(candidates: DataFrame, cand_id: str, cand_vec: str, queries: DataFrame, query_id: str,
            query_vec: str, k: int) -> DataFrame:
    """Exact cosine top-k candidates per query: (query_id, cand_id, score, rank), ties by candidate id.

    Vectors have one length; queries need distinct ids.
    """
    query_sql, cand_sql = dict(queries.dtypes)[query_id], dict(candidates.dtypes)[cand_id]
    blocks = cut_lineage(packed(candidates, cand_id, cand_vec))
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    n = blocks.count()
    groups = max(1, -(-n // GROUP_BLOCKS), min(n, cores))
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    asked = packed(queries, query_id, query_vec).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    found = best_by_group(dealt_blocks(grouped, asked, query_sql, cand_sql), k, arrow_type(queries, query_id), arrow_type(candidates, cand_id), query_sql, cand_sql)
    return ranked(found, k).withColumnRenamed("query_id", query_id).withColumnRenamed("cand_id", cand_id)
