"""Run queries against their DuckDB oracle: ``python -m tests.oracle [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, bool):
        return v
    try:
        return float(v) + 0.0
    except (TypeError, ValueError):
        return str(v)


def bag(rows: list[tuple], names: list[str]) -> Counter:
    """Multiset of rows with the columns in name order."""
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_cell(r[k]) for k in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    relation = con.sql(sql)
    if sorted(relation.columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    ours, theirs = bag([tuple(r) for r in df.collect()], df.columns), bag(relation.fetchall(), relation.columns)
    if ours == theirs:
        return None
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; ours only {list((ours - theirs).items())[:3]}; oracle only {list((theirs - ours).items())[:3]}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, oracles = session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        t = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracles:
                problem = differences(df, con, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
