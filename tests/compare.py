"""Runs a registered query in Spark and its SQL in DuckDB and compares them."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from lakesteward.plans.fixtures import TABLES


def second_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark: SparkSession, db, query, sql: str, sf_dir: str) -> str:
    """Empty when both engines agree on columns, row count and values."""
    frame = query(spark, sf_dir)
    ours = _bag(frame.collect(), frame.columns)
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _bag(result.fetchall(), columns)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {frame.columns} against {columns}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; only here {sum(extra.values())}: "
            f"{list(extra)[:2]}; only there {sum(missing.values())}: {list(missing)[:2]}"
        )
    return ""
