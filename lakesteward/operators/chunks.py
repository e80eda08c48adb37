"""Contiguous chunks of a table and fixed-size batches for callbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.session import cut

# monotonically_increasing_id keeps the row's place within its partition in the low bits.
_PLACE_BITS = 33


def chunk_rows(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """Adds ``position`` (from 0, in key order) and ``chunk_id = position / size``.

    Range partitioning spreads the sort over all tasks; a hash of the row and
    its place in the input break ties, so equal keys do not pile up in one task. The
    sorted rows are checkpointed once, which fixes partition numbers and places.
    Then only one count per partition is needed to number all rows: there is no
    window over the whole table.
    """
    if size < 1:
        raise ValueError("chunk size must be at least 1")
    if not keys:
        raise ValueError("chunk_rows needs sort keys")
    plain = [f.name for f in df.schema.fields if not _holds_map(f.dataType)]
    tied = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in plain])).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    order = [*keys, "_hash", "_place"]
    ordered = cut(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_place"))
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_id", _PLACE_BITS).cast("int")
    )
    # One row per partition, as many as the task list the driver holds anyway.
    counts = placed.groupBy("_part").count().orderBy("_part").collect()
    starts, total = [], 0
    for row in counts:
        starts.append((row["_part"], total))
        total += row["count"]
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    numbered = placed.join(F.broadcast(offsets), "_part")
    place = F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        numbered.withColumn("position", F.col("_start") + place)
        .withColumn("chunk_id", F.floor(F.col("position") / F.lit(size)).cast("bigint"))
        .drop("_id", "_part", "_start")
    )


def _holds_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _holds_map(t.elementType)
    return isinstance(t, T.StructType) and any(_holds_map(f.dataType) for f in t.fields)


def in_batches(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Re-slices a stream of frames into frames of ``size`` rows and a short tail."""
    held: list[pd.DataFrame] = []
    rows = 0
    for frame in frames:
        start = 0
        while len(frame) - start >= size - rows:
            stop = start + size - rows
            held.append(frame.iloc[start:stop])
            yield pd.concat(held, ignore_index=True)
            held, rows, start = [], 0, stop
        if start < len(frame):
            held.append(frame.iloc[start:])
            rows += len(frame) - start
    if rows:
        yield pd.concat(held, ignore_index=True)


def batch_process(
    df: DataFrame,
    size: int,
    callbacks: Sequence[Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Hands batches of ``size`` rows to the callbacks and returns the rows they give back.

    Batches are cut per partition, so every partition may end with a short
    one; a partition without rows calls nothing. At most one batch is held at a
    time. An error in a callback fails the job. Tasks may be run again after a lost
    executor, so callbacks with outside effects must be repeatable.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in in_batches(frames, size):
            for callback in callbacks:
                yield callback(batch.copy())

    return df.mapInPandas(run, schema)
