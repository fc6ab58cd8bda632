"""Compare registered queries with their SQL oracles; used by tests and by hand."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, query, sql: str, folder: str) -> str:
    """Empty text when equal, else what differs."""
    frame = query(spark, folder)
    mine = _rows(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _rows(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if mine != theirs:
        missing = [r for r in theirs if r not in set(mine)][:2]
        extra = [r for r in mine if r not in set(theirs)][:2]
        return f"{len(mine)} rows != {len(theirs)}; missing {missing}; extra {extra}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    import __spark_entry__ as contract
    from tidewarden.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            if name in oracles:
                outcome = compare(spark, connection, query, oracles[name], folder) or "ok"
            else:
                outcome = f"rows only: {query(spark, folder).count()}"
        except Exception as error:
            outcome = f"FAILED {str(error)[:600]}"
        print(f"{name:32s} {time.time() - began:6.2f}s {outcome}", flush=True)
    print("without a query:", sorted(set(oracles) - set(contract.queries())))
