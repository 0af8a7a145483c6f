"""Run registered queries against their SQL on the same parquet tables.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, values in one comparable form, rows sorted."""
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        col = frame[c]
        if pd.api.types.is_float_dtype(col):
            frame[c] = [None if pd.isna(v) else repr(float(v) + 0.0) for v in col]
        elif pd.api.types.is_datetime64_any_dtype(col):
            frame[c] = col.astype("datetime64[us]").astype(str)
        else:
            frame[c] = [None if v is None or v is pd.NA or (isinstance(v, float) and v != v) else _text(v) for v in col]
    frame = frame.astype(object).where(frame.notna(), "<null>").astype(str)
    return frame.sort_values(list(frame.columns)).reset_index(drop=True) if len(frame.columns) else frame


def _text(v) -> str:
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    text = str(v)
    return text[:10] if text.endswith(" 00:00:00") else text


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str:
    """Empty when both sides agree, else what differs."""
    got = _plain(fn(spark, sf_dir).toPandas())
    want = _plain(con.execute(sql).df())
    if list(got.columns) != list(want.columns):
        return f"columns {list(got.columns)} vs {list(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for c in got.columns:  # dates may come as days or as midnights
        if (got[c].str.len() == 10).all() and want[c].str.endswith(" 00:00:00").all():
            want[c] = want[c].str[:10]
    got, want = (f.sort_values(list(f.columns)).reset_index(drop=True) for f in (got, want))
    bad = (got != want).any(axis=1)
    if bad.any():
        i = bad.idxmax()
        return f"{int(bad.sum())} of {len(got)} rows differ, first: {got.loc[i].to_dict()} vs {want.loc[i].to_dict()}"
    return "" if len(got) else "no rows on either side"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    import __spark_entry__ as entry
    from tilth.session import build_session

    spark = build_session(
        "oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args.names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, name, queries[name], oracles[name], args.sf)
            else:
                rows = queries[name](spark, args.sf).toPandas()
                problem = "" if len(rows) else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in oracles else "ok (rows)")
        print(f"{mark:10s} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
