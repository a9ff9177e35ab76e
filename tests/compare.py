"""Runs registered queries and their SQL on one data folder and compares rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides have the same columns and rows."""
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    theirs = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    pairs = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b or list(map(type, a)) != list(map(type, b))]
    if pairs:
        return f"{len(pairs)} of {len(ours[1])} rows differ, first {pairs[0][0]} != {pairs[0][1]}"
    return None


def main(folder: str, names: list[str]) -> int:
    from conftest import session

    import __spark_entry__ as entry

    spark, con, bad = session(), duck(folder), 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            result = difference(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None and not result.startswith("rows only")
        print(f"{name:32s} {time.time() - start:6.2f}s  {result or 'equal'}", flush=True)
    return bad


if __name__ == "__main__":
    data = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(data, sys.argv[2:]))
