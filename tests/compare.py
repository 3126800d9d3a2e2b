"""Compare a Spark result with its SQL twin in DuckDB, without regard to row order."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

from recontact.checks.sample import GIVEN


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 6) + 0.0
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql) -> tuple[str | None, int]:
    """None when equal, else a description; with the number of Spark rows."""
    spark_rows = df.collect()
    cur = con.execute(sql)
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    names, have = rows_of(df.columns, spark_rows)
    if names != want_names:
        return f"columns {names} != {want_names}", len(spark_rows)
    if have != want:
        extra, missing = have - want, want - have
        return (
            f"{sum(have.values())} vs {sum(want.values())} rows; only in Spark {list(extra)[:3]}; "
            f"only in SQL {list(missing)[:3]}",
            len(spark_rows),
        )
    return None, len(spark_rows)
