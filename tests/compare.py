"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

As a script: ``python tests/compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    return value if value is None else str(value)


def rows(columns, lines) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(line[i]) for i in order) for line in lines), key=repr)


def difference(spark_df, db, sql: str) -> str | None:
    """None when both engines give the same column names and the same rows."""
    mine_names, mine = spark_df.columns, rows(spark_df.columns, spark_df.collect())
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(mine_names) != sorted(names):
        return f"columns differ: {sorted(mine_names)} and {sorted(names)}"
    if len(mine) != len(theirs):
        return f"row counts differ: {len(mine)} and {len(theirs)}; {mine[:2]} {theirs[:2]}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry

    from quarryline.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark, db = local_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = []
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = difference(df, db, oracles[name])
                kind = "sql "
            else:
                problem, kind = (None if df.collect() else "no rows"), "rows"
        except Exception as error:  # report and go on with the next query
            problem, kind = f"{type(error).__name__}: {str(error)[:1500]}", "err "
        if problem:
            failed.append(name)
        print(f"{time.time() - start:7.2f}s {kind} {name}: {problem or 'ok'}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
