"""Compare named queries with their SQL on DuckDB: ``python -m tests.oracle FOLDER [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _plain(value):
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of_spark(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, sorted(rows, key=repr)


def rows_of_sql(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    rows = [tuple(_plain(r[i]) for i in at) for r in result.fetchall()]
    return names, sorted(rows, key=repr)


def difference(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    names, ours = rows_of_spark(df)
    wanted, theirs = rows_of_sql(db, sql)
    if names != wanted:
        return f"columns {names} and {wanted}"
    if ours != theirs:
        only, missing = sorted(set(ours) - set(theirs), key=repr), sorted(set(theirs) - set(ours), key=repr)
        return f"{len(ours)} and {len(theirs)} rows; only ours {only[:3]}; only SQL {missing[:3]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, db = make_session(), connect(folder)
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name in wanted or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem = difference(df, db, oracles[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
