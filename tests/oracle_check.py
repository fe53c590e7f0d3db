"""Run registered queries in Spark and their SQL in DuckDB, and compare the results.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``. Also imported by the tests.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, sorted(rows, key=repr)


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], sorted(rows, key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    t0 = time.time()
    s_cols, s_rows = rows_of_spark(E.queries()[name](spark, sf_dir))
    t1 = time.time()
    sql = E.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["match"] = None
        return out
    d_cols, d_rows = rows_of_duck(con, sql)
    out.update(
        oracle_rows=len(d_rows),
        columns_match=s_cols == d_cols,
        match=s_cols == d_cols and s_rows == d_rows,
    )
    if not out["match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        diff = [r for r in s_rows if r not in set(d_rows)][:3]
        out["spark_only"] = diff
        out["oracle_only"] = [r for r in d_rows if r not in set(s_rows)][:3]
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E

    names = argv[2:] or list(E.queries())
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as exc:  # report and go on with the next query
            r = {"name": name, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        if not r.get("match"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} match", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
