"""Run registered queries next to their SQL in DuckDB and report differences.

usage: python tests/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback

import duckdb
import numpy as np
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype == object or str(df[c].dtype).startswith(("str", "datetime", "date")):
            sample = df[c].dropna()
            if len(sample) and isinstance(sample.iloc[0], (list, tuple, np.ndarray)):
                df[c] = df[c].map(lambda v: ",".join(f"{x:.6f}" if isinstance(x, float) else str(x) for x in v))
            elif len(sample) and not isinstance(sample.iloc[0], str):
                df[c] = df[c].map(str)
    return df.sort_values(list(df.columns), ignore_index=True)


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} vs {len(sql_df)}"
    kinds = {c: (spark_df[c].dtype.kind, sql_df[c].dtype.kind) for c in spark_df.columns}
    kinds = {c: k for c, k in kinds.items() if k[0] != k[1] and set(k) & set("if")}
    a, b = normal(spark_df), normal(sql_df)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            at = np.flatnonzero(~same.to_numpy())
            return f"values of {c}: {len(at)} differ, e.g. {a.iloc[at[0]].to_dict()} vs {b.iloc[at[0]].to_dict()}"
    return f"kinds {kinds}" if kinds else ""


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(sf)):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{sf}/{name}')")
    return con


def main() -> int:
    from minegrain.runtime import local_session
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = entry.queries(), entry.oracle_sql()
    con, bad, total = connect(sf), 0, time.time()
    for name, fn in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            out = fn(spark, sf).toPandas()
            took = time.time() - start
            if name in sql:
                problem = compare(out, con.execute(sql[name]).df())
                state = "OK " if not problem else "BAD"
            else:
                problem, state = f"rows only: {len(out)}", "-- "
                if len(out) == 0:
                    state = "BAD"
        except Exception as e:
            problem, state, took, out = f"{type(e).__name__}: {str(e)[:600]}", "ERR", time.time() - start, []
            if names:
                traceback.print_exc(limit=4)
        bad += state in ("BAD", "ERR")
        print(f"{state} {name:32s} {took:6.2f}s rows={len(out)} {problem}", flush=True)
    print(f"bad={bad} total={time.time() - total:.1f}s")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
