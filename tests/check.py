"""Compare registered queries with their SQL in DuckDB: ``python tests/check.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return str(v.date()) if v == v.normalize() else str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if len(v.isoformat()) == 10 else str(pd.Timestamp(v))
    if isinstance(v, float):
        return v
    if hasattr(v, "item"):
        return v.item()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark, con, name: str, sf_dir: str) -> tuple[list[str], int]:
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [], len(got)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"], len(got)
    problems = []
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. {bad[0]}")
    return problems, len(got)


def main() -> int:
    from runscope.session import build_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    sql = entry.oracle_sql()
    for name in chosen or entry.queries():
        began = time.time()
        try:
            problems, n = differences(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            problems, n = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        failed += bool(problems)
        kind = "sql " if name in sql else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {kind} {name:28} {n:7} rows {time.time() - began:6.2f}s", *problems, flush=True)
    print("failed:", failed, "of", len(chosen or entry.queries()))
    return failed


if __name__ == "__main__":
    sys.exit(main())
