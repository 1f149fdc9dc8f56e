"""Run registered queries beside their SQL and compare the rows exactly.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "DATE": "date", "BOOLEAN": "boolean",
}


def duck_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(folder, f"{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> list:
    return [(value is not None, str(type(value)), value if value is not None else 0)
            for value in row]


def normalise(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [
        tuple(
            "NaN" if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order
        )
        for row in rows
    ]
    return sorted(cells, key=_key)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Texts on what differs between a Spark result and a SQL result; empty if nothing does."""
    result = con.execute(sql)
    duck_types = {c[0]: DUCK_TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    spark_types = dict(df.dtypes)
    problems = []
    if duck_types != spark_types:
        odd = set(duck_types.items()) ^ set(spark_types.items())
        problems.append(f"schema: {sorted(odd)}")
        if set(duck_types) != set(spark_types):
            return problems
    expected = normalise(list(duck_types), result.fetchall())
    actual = normalise(df.columns, [tuple(row) for row in df.collect()])
    if len(actual) != len(expected):
        problems.append(f"rows: {len(actual)} instead of {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} instead of {wrong[0][1]}")
    return problems


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points

    from quotewell.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("compare")
    con = duck_connection(folder)
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracle:
                problems = differences(df, con, oracle[name])
                verdict = "; ".join(problems) or "equal"
            else:
                problems, verdict = [], f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [str(error)]
            verdict = "error: " + str(error)[:600]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:26s} {time.time() - start:6.2f}s {verdict}",
              flush=True)
    print(f"{failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    raise SystemExit(main())
