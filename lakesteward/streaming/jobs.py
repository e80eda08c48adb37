"""The stateless jobs on streams.

Jobs A to D are projections and explodes, so a streaming DataFrame can go
through the same functions. These helpers add the source and the sink.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, path: str, schema, source: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(source).load(path)


def run_job(
    stream: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    source: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Job over a stream into files: exactly once, by the file sink's own log."""
    writer = job(stream).writeStream.outputMode("append").format(source)
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def each_batch(
    stream: DataFrame,
    callbacks: list[Callable[[DataFrame, int], None]],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Hands every micro-batch to the callbacks in turn; the first error stops the query.

    A batch may be handed over again after a failure, so callbacks should key
    their effects on the batch number.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist() if len(callbacks) > 1 else batch
        try:
            if not held.isEmpty():
                for callback in callbacks:
                    callback(held, batch_id)
        finally:
            if held.is_cached:
                held.unpersist()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
