"""Run queries next to their DuckDB SQL and compare the rows.

    python tests/oracle_check.py [sf] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DATA = Path("/root/testdata")


def oracle_connection(sf_dir: Path):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> str | None:
    """None when both sides have the same columns and rows, otherwise what differs."""
    got_columns = df.columns
    got = _sorted([tuple(r) for r in df.collect()], got_columns)
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = _sorted(cursor.fetchall(), want_columns)
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference: {str(a)[:600]} != {str(b)[:600]}"
    return None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from wayword.session import local_session

    args = sys.argv[1:]
    sf_dir = DATA / f"sf{args[0] if args else '0.01'}"
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = oracle_connection(sf_dir)
    oracle = oracle_sql()
    for name, fn in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            problem = compare(fn(spark, str(sf_dir)), con, oracle[name]) if name in oracle else "no oracle"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main()
