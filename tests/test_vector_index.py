import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import vector_index as I
from tessera.operators import vectors as V


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(2)
    heart = r.normal(size=(12, 16))
    data = [(i, (heart[i % 12] + 0.3 * r.normal(size=16)).tolist()) for i in range(900)]
    data += [(1000 + i, data[5][1]) for i in range(60)] + [(2000, [0.0] * 16), (2001, None)]  # ties, no direction, no vector
    return spark.createDataFrame(data, "id long, v array<double>")


def exact_by_hand(rows, k):
    data = [(r.id, np.array(r.v)) for r in rows.collect() if r.v is not None]
    unit = {i: v / np.linalg.norm(v) if np.linalg.norm(v) else v for i, v in data}
    out = set()
    for q in (i for i in unit if i % 20 == 0):
        best = sorted(((-round(float(unit[q] @ u), 12), i) for i, u in unit.items()))[:k]
        out |= {(q, i) for _, i in best}
    return out


def pairs(df, a="query_id", b="cand_id"):
    return {(r[a], r[b]) for r in df.collect()}


def test_exact_neighbours_by_blocks(spark, rows, monkeypatch):
    queries = rows.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    found = V.nearest(rows, "id", "v", queries, "query_id", "v", 3)
    # ties of equal vectors go to the smallest ids
    assert pairs(found, "query_id", "id") == exact_by_hand(rows, 3)
    assert [r.rank for r in found.where("query_id = 0").orderBy("rank").collect()] == [1, 2, 3]
    assert V.nearest(rows.limit(0), "id", "v", queries, "query_id", "v", 3).isEmpty()
    assert V.nearest(rows, "id", "v", queries.limit(0), "query_id", "v", 3).isEmpty()


def test_index_reaches_its_recall_and_is_exact_with_all_lists(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "PART_ROWS", 40)  # lists in several parts
    index = I.build(rows, "id", "v", str(tmp_path), lists=12)
    blocks = index.blocks(spark)
    assert blocks.agg(F.sum("n")).first()[0] == 961
    assert blocks.groupBy("list").agg(F.count_distinct("part").alias("n")).where("n > 1").count() > 0
    queries = rows.where("id % 20 = 0 and id < 2000").withColumnRenamed("id", "query_id")
    exact = V.nearest(rows, "id", "v", queries, "query_id", "v", 5).withColumnRenamed("id", "cand_id").checkpoint()
    assert pairs(I.search(index, queries, "query_id", "v", 5, 12)) == pairs(exact)
    probes = I.tuned_probes(index, queries, "query_id", "v", exact, 0.9)
    assert probes < 12 and I.recall(I.search(index, queries, "query_id", "v", 5, probes), exact) >= 0.9


def test_string_ids(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0])], "id string, v array<float>")
    found = V.nearest(df, "id", "v", df.select(F.col("id").alias("q"), "v"), "q", "v", 2)
    assert pairs(found, "q", "id") == {("a", "a"), ("a", "b"), ("b", "b"), ("b", "a"), ("c", "c"), ("c", "b")}
