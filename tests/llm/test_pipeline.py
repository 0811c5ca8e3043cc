import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, set_join

from odd_cases import odd_rows


def staged(spark, docs, tmp_path):
    """Outputs of all stages, each written and read again."""
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        stage(spark, out[-1], "").write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_on_odd_rows(spark, odd, tmp_path):
    docs, language, exact, near, mixed, encoded = staged(spark, odd, tmp_path)
    assert all(x.columns == docs.columns for x in (language, exact, near, mixed))
    letters = [r for r in odd_rows() if any(c.isalpha() for c in r[1] or "")]
    assert language.count() == len(letters)
    assert exact.count() == exact_dedup.dedup(language).where("kept").count() == exact.select(F.regexp_replace("text", r"[\x20\x09-\x0D]", "")).distinct().count()
    assert near.count() == set_join.components(exact).where("stays").count()
    assert mixed.select("doc_id", "text").distinct().exceptAll(near.select("doc_id", "text").distinct()).isEmpty()
    assert encoded.count() == mixed.count() and encoded.where("not round_trip").count() == 0


def test_run_on_the_smallest_table(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and found.where("n_tokens <> size(ids) or not round_trip").count() == 0


def test_empty_documents(spark, empty, tmp_path):
    assert [x.count() for x in staged(spark, empty, tmp_path)] == [0] * 6


def test_queries_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 11)} <= {x[:x.index("_") + 1] for x in names if x.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_bm25_top_k", "op6_exact_dedup"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tessera.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    found = QUERIES[name](spark, "/root/testdata/sf0.01")
    want = con.execute(ORACLES[name]).df()[found.columns]
    assert sorted(map(repr, found.toPandas().itertuples(index=False, name=None))) == sorted(map(repr, want.itertuples(index=False, name=None)))
