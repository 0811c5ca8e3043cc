"""Local stand-in for the driver's correctness gate.

Runs each registered Spark query and its DuckDB oracle at one scale factor
and compares row count, column names and an order-insensitive multiset of
rounded row values. Usage: python tests/oracle_compare.py [sf_dir] [names...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.session import get_session  # noqa: E402
from tessera.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for rec in df_pd[cols].itertuples(index=False):
        out.append(tuple(_norm(x.item() if hasattr(x, "item") and not isinstance(x, (list, dict)) else
                               (list(x) if hasattr(x, "tolist") else x)) for x in rec))
    return cols, out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from __spark_entry__ import oracle_sql, queries
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            sp = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"rows {name}: {len(sp)} rows ({dt:.1f}s, no oracle)")
            continue
        try:
            dk = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        c1, r1 = rows_of(sp)
        c2, r2 = rows_of(dk)
        if c1 != c2:
            print(f"FAIL {name}: columns {c1} vs {c2}")
            bad += 1
            continue
        s1, s2 = sorted(map(repr, r1)), sorted(map(repr, r2))
        if s1 != s2:
            diff1 = [x for x in set(s1) - set(s2)][:3]
            diff2 = [x for x in set(s2) - set(s1)][:3]
            print(f"FAIL {name}: {len(r1)} vs {len(r2)} rows; spark-only {diff1}\n   duck-only {diff2}")
            bad += 1
            continue
        print(f"ok   {name}: {len(r1)} rows ({dt:.1f}s)")
    print("bad:", bad)


if __name__ == "__main__":
    main()
