import __spark_entry__ as E
from tessera.plans.registry import all_queries


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "split" in df.columns


def test_oracles_cover_registered_queries():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 80


def test_query_names_are_unique_and_plain():
    for name in all_queries():
        assert name.isidentifier() and not name.startswith("op")
