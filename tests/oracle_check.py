"""Compare registered queries with their SQL on the same tables.

Usage: python tests/oracle_check.py [sf dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def digest(columns, rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(row[i]) for i in order) for row in rows)
    return sorted(columns), len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    if digest(df.columns, got) == digest(cols, want):
        return None
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} != {sorted(cols)}"
    pick = [df.columns.index(c) for c in cols]
    a = {"|".join(_cell(r[i]) for i in pick) for r in got}
    b = {"|".join(map(_cell, r)) for r in want}
    return f"{len(got)} rows vs {len(want)}; only Spark {sorted(a - b)[:2]}; only SQL {sorted(b - a)[:2]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from tessella.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "oracle_check", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    session.sparkContext.setLogLevel("ERROR")
    database, bad = connect(sf), 0
    for query in sys.argv[2:] or queries():
        start = time.time()
        try:
            problem = compare(session, database, query, sf) if query in oracle_sql() else "no SQL"
        except Exception as error:  # report and go on
            problem = f"error {str(error)[:500]}"
        bad += problem is not None
        print(f"{query:26s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))
