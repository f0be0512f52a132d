"""Run registered queries on Spark and their oracle SQL on DuckDB; compare
row count, column names and the multiset of rows (order-insensitive).

    python -m harness.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
                 "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(_norm(x) for x in r) for r in df.collect()]


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    return rel.columns, [tuple(_norm(x) for x in r) for r in rel.fetchall()]


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    s_cols, s_rows = rows_of_spark(query(spark, sf_dir))
    t1 = time.time()
    d_cols, d_rows = rows_of_duck(con, sql)
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if res["columns_match"]:
        order = [d_cols.index(c) for c in s_cols]
        d_rows = [tuple(r[i] for i in order) for r in d_rows]
        diff_s = Counter(s_rows) - Counter(d_rows)
        diff_d = Counter(d_rows) - Counter(s_rows)
        res["values_match"] = not diff_s and not diff_d
        if not res["values_match"]:
            res["only_spark"] = list(diff_s.elements())[:3]
            res["only_oracle"] = list(diff_d.elements())[:3]
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    return res


def main(argv: list[str]) -> int:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from harness.oracle import ORACLE
    from harness.registry import QUERIES
    from harness.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, QUERIES[n], ORACLE[n], sf_dir)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "error": repr(e)[:400]}
        ok = r.get("values_match") and r.get("rows") == r.get("oracle_rows")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
