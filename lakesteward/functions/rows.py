"""Filters and explodes that evaluate their input once.

Catalyst pushes a filter through the projection that computes its input, and
puts a filter of its own below every inner explode. Both repeat the input
expression, which is costly when that is a parse. Nothing that looks at
the output of an outer explode can be pushed below it, so these helpers go
through one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows of costly work that one task is meant to have.
TASK_ROWS = 50_000


def dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The same rows in tasks of about so many, and in one for every core at least.

    For work that is large beside its input: a file gives no more tasks than it has row groups, however many splits it is read in. Called on
    what the work is made from, it moves only the columns that the work reads.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // task_rows))
    return df.repartition(tasks)


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """``df.where(condition)`` with the condition evaluated in place."""
    return df.withColumn("_keep", F.explode_outer(F.array(condition))).where("_keep").drop("_keep")


def settle(df: DataFrame, inside: Sequence[str]) -> DataFrame:
    """The same rows and columns; filters that follow read the ``inside`` columns instead of repeating how they are made.

    Filters on other columns still reach the scan.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in inside]
    held = df.select(*kept, F.explode_outer(F.array(F.struct(*[F.col(f"`{c}`") for c in inside]))).alias("_settled"))
    return held.select(*[F.col("_settled")[c].alias(c) if c in inside else F.col(f"`{c}`") for c in df.columns])


def unnest(df: DataFrame, array: Column, name: str) -> DataFrame:
    """One row per element; elements must not be NULL."""
    return df.withColumn(name, F.explode_outer(array)).where(F.col(name).isNotNull())


def unnest_placed(df: DataFrame, array: Column, place: str, name: str, *keep: str) -> DataFrame:
    """One row per element with its place from 0, and the columns to keep."""
    return df.select(*keep, F.posexplode_outer(array).alias(place, name)).where(F.col(place).isNotNull())
