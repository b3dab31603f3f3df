"""Run registered queries next to their SQL and compare the results.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, str(v)) for v in row)


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_sortable)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0, abs_tol=0)
    return type(a) is type(b) and a == b


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    df = queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    for a, b in zip(ours, theirs, strict=True):
        if not all(map(_same, a, b)):
            return f"{str(a)[:600]} / {str(b)[:600]}"
    return None


if __name__ == "__main__":
    from casemill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in sys.argv[2:] or oracle_sql():
        started = time.time()
        found = difference(spark, connection, name, sf_dir)
        print(f"{'same' if found is None else 'DIFF'} {name} {time.time() - started:.1f}s {found or ''}")
    print("no SQL:", sorted(set(queries()) - set(oracle_sql())))
