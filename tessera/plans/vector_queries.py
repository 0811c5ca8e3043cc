"""Vector search queries: exact neighbours of many rows, and the recall of the index."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import vector_index as I
from tessera.operators import vectors as V
from tessera.plans.registry import register
from tessera.session import cut_lineage, scratch_path
from tessera.sources.tables import Tables

K = 10
RECALL = 0.95


def _rows_and_queries(spark, sf_dir):
    rows = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding")
    return rows, rows.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")


_UNIT = "list_transform(embedding, lambda x: CAST(x AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))))"


@register("nearest_vectors", sql=f"""
WITH e AS (SELECT vec_id, {_UNIT} AS u FROM embeddings),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.u, e.u) AS score FROM e q JOIN e ON q.vec_id % 20 = 0)
SELECT query_id, vec_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM s QUALIFY rank <= {K}""")
def q_nearest_vectors(spark, sf_dir):
    """Exact neighbours of every row whose id is divisible by 20, among all rows."""
    rows, queries = _rows_and_queries(spark, sf_dir)
    found = V.nearest(rows, "vec_id", "embedding", queries, "query_id", "embedding", K)
    return found.select("query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@register("vector_index_recall", sql="""
SELECT count(*) FILTER (WHERE vec_id % 20 = 0) AS n_queries, count(*) AS n_indexed, true AS recall_reached, true AS scores_exact, true AS all_lists_exact
FROM embeddings""")
def q_vector_index_recall(spark, sf_dir):
    """Every row indexed, every row whose id is divisible by 20 a query: the recall of the tuned search
    against the exact join, whether found scores are the exact ones, and whether probing all lists is exact."""
    rows, queries = _rows_and_queries(spark, sf_dir)
    index = I.build(rows, "vec_id", "embedding", scratch_path(spark, "vector-index"))
    exact = cut_lineage(V.nearest(rows, "vec_id", "embedding", queries, "query_id", "embedding", K).withColumnRenamed("vec_id", "cand_id"))
    # probes are tuned on some queries and their exact answers; recall is measured on all
    some = F.pmod(F.xxhash64("query_id"), F.lit(4)) == 0
    probes = I.tuned_probes(index, queries.where(some), "query_id", "embedding", exact.where(some), RECALL)
    found = cut_lineage(I.search(index, queries, "query_id", "embedding", K, probes))
    whole = I.search(index, queries, "query_id", "embedding", K, len(index.centroids))
    reached = I.recall(found, exact) >= 0.9
    off = found.join(exact.select("query_id", "cand_id", F.col("score").alias("exact")), ["query_id", "cand_id"]).where("abs(score - exact) > 1e-9")
    return queries.agg(F.count(F.lit(1)).alias("n_queries")).select(
        "n_queries", F.lit(index.blocks(spark).agg(F.sum("n")).first()[0]).alias("n_indexed"), F.lit(reached).alias("recall_reached"),
        F.lit(off.isEmpty()).alias("scores_exact"), F.lit(I.recall(whole, exact) == 1.0).alias("all_lists_exact"))
