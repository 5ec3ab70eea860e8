"""Run a query and its SQL side by side and report the first differences."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
            return str(v)
        return f"{float(v):.10g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns: {sorted(df.columns)} against {sorted(names)}"
    if len(set(df.columns)) != len(df.columns):
        return f"repeated columns: {df.columns}"
    if not expected:
        return "no rows to compare"
    if got == expected:
        return None
    a, b = set(got), set(expected)
    return (f"rows: {len(got)} against {len(expected)}; columns {sorted(names)}; "
            f"only here {sorted(a - b)[:3]}; only there {sorted(b - a)[:3]}")


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from lakeops.session import local_session

    spark, con, bad = local_session(), connect(folder), 0
    oracle = entry.oracle_sql()
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in oracle:
                problem = difference(df, con, oracle[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
