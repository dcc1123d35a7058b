"""Comparison of registered queries with their SQL, on whole results.

As a program: ``python tests/compare.py <data folder> [query ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return repr(round(value, 9))
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return str(value)


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(frame, sql: str, connection) -> list[str]:
    """What differs between a Spark result and a SQL result; nothing if they are equal."""
    mine, mine_rows = _rows(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    theirs, their_rows = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found = []
    if mine != theirs:
        found.append(f"columns {mine} against {theirs}")
    if len(mine_rows) != len(their_rows):
        found.append(f"{len(mine_rows)} rows against {len(their_rows)}")
    if mine_rows != their_rows:
        only_mine, only_theirs = sorted(set(mine_rows) - set(their_rows)), sorted(set(their_rows) - set(mine_rows))
        found.append(f"only Spark ({len(only_mine)}): {only_mine[:2]}; only SQL ({len(only_theirs)}): {only_theirs[:2]}")
    return found


def main() -> None:
    from radiolith.plans.catalog import REGISTRY
    from radiolith.plans.oracle import ORACLE
    from radiolith.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = oracle_connection(sf_dir)
    failed = 0
    for name, query in REGISTRY.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in ORACLE:
                result = differences(query(spark, sf_dir), ORACLE[name], connection)
            else:
                result = [] if query(spark, sf_dir).count() else ["no rows"]
        except Exception as error:  # report and go on to the next query
            result = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(result)
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not result else 'DIFFERS'}", *result, sep="\n    " if result else " ", flush=True)
    print("failed:", failed, "unregistered SQL:", sorted(set(ORACLE) - set(REGISTRY)))


if __name__ == "__main__":
    main()
