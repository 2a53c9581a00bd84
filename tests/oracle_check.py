"""Runs queries next to their SQL and reports differences.

``python tests/oracle_check.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def type_name(text: str) -> str:
    """Spark and DuckDB type names as one of a few common ones."""
    same = {
        "bigint": "bigint", "int": "int", "integer": "int", "double": "double", "string": "text",
        "varchar": "text", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
        "boolean": "boolean",
    }
    return same.get(text.lower(), text.lower())


def compare(con, df, text: str) -> list[str]:
    """Differences in columns, types and rows; empty if there are none."""
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    described = con.execute(f"DESCRIBE {text}").fetchall()
    expected_types = {r[0]: r[1] for r in described}
    problems = []
    if sorted(expected_types) != columns:
        return [f"columns {columns} != {sorted(expected_types)}"]
    for c in columns:
        if type_name(types[c]) != type_name(expected_types[c]):
            problems.append(f"type of {c}: {types[c]} != {expected_types[c]}")
    rows = con.execute(f"SELECT {', '.join(columns)} FROM ({text})").fetchall()
    want = sorted(tuple(plain(v) for v in r) for r in rows)
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        extra = sorted(set(got) - set(want))[:2]
        lacking = sorted(set(want) - set(got))[:2]
        problems.append(f"values: only here {extra}, only there {lacking}")
    if not got:
        problems.append("no rows")
    return problems


def main() -> None:
    from bellwire.session import build_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in oracles:
                problems = compare(con, queries[name](spark, sf_dir), oracles[name])
                kind = "sql"
            else:
                problems = [] if queries[name](spark, sf_dir).count() else ["no rows"]
                kind = "rows"
        except Exception as error:  # noqa: BLE001
            problems, kind = [f"{type(error).__name__}: {str(error)[:600]}"], "error"
        failed += bool(problems)
        state = "ok  " if not problems else "FAIL"
        print(f"{state} {name} [{kind}] {time.time() - start:.1f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")


if __name__ == "__main__":
    main()
