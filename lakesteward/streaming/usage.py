"""Usage as a stream: sessions of users, and the first and last use of each table."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def usage_sessions(events: DataFrame, user: str, time: str, gap: str, delay: str | None = None) -> DataFrame:
    """``user, started, ended, events`` of each run of a user's events that lie less than ``gap`` apart.

    The same for a table and for a stream. On a stream, ``delay`` is how late events may come: a session is given out once
    the watermark is past its end, and later events of it are dropped. Events are combined into
    sessions before the shuffle.
    """
    held = events.select(F.col(f"`{user}`").alias("user"), F.col(f"`{time}`").alias("at"))
    if delay:
        held = held.withWatermark("at", delay)
    return held.groupBy(F.session_window("at", gap).alias("w"), "user").agg(
        F.min("at").alias("started"), F.max("at").alias("ended"), F.count("*").alias("events")
    ).select("user", "started", "ended", "events")


class _LastUse(StatefulProcessor):
    """Keeps first use, last use and number of uses of a key, until the watermark is ``timeout`` past its last use."""

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.use = handle.getValueState("use", "first_us long, last_us long, uses long")

    def _row(self, key, first: int, last: int, uses: int, ended: bool) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "first_us": [first], "last_us": [last], "uses": [uses], "ended": [ended]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = last = None
        uses = 0
        if self.use.exists():
            first, last, uses = self.use.get()
        for part in rows:
            low, high = int(part["first_us"].min()), int(part["last_us"].max())
            first = low if first is None else min(first, low)
            last = high if last is None else max(last, high)
            uses += int(part["uses"].sum())
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.use.update((first, last, uses))
        self.handle.registerTimer(last // 1000 + self.timeout_ms)
        yield self._row(key, first, last, uses, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, last, uses = self.use.get()
        self.use.clear()
        yield self._row(key, first, last, uses, True)

    def close(self) -> None:
        pass


def last_use(events: DataFrame, key: str, time: str, delay: str, timeout_ms: int) -> DataFrame:
    """``key, first_us, last_us, uses, ended`` from a stream: a row whenever a key's use changes, and one with ``ended`` when it times out.

    A key that is used again after it ended starts anew. Times are microseconds since 1970. Each micro-batch is added up by
    key and partition first, so a key with a third of all rows sends a few rows only.
    """
    held = events.select(F.col(f"`{key}`").alias("key"), F.col(f"`{time}`").alias("at"))
    micros = held.select("key", "at", F.unix_micros("at").alias("us"))

    def combine(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            grouped = part.groupby("key", sort=False)["us"].agg(["min", "max", "size"]).reset_index()
            latest = part.groupby("key", sort=False)["at"].max().reset_index(drop=True)
            yield pd.DataFrame({
                "key": grouped["key"], "at": latest, "first_us": grouped["min"], "last_us": grouped["max"], "uses": grouped["size"].astype("int64"),
            })

    kind = events.schema[key].dataType.simpleString()
    summed = micros.mapInPandas(combine, f"key {kind}, at timestamp, first_us long, last_us long, uses long")
    return summed.withWatermark("at", delay).groupBy("key").transformWithStateInPandas(
        statefulProcessor=_LastUse(timeout_ms), outputStructType=f"key {kind}, first_us long, last_us long, uses long, ended boolean",
        outputMode="Update", timeMode="EventTime",
    )


def run_last_use(
    spark: SparkSession, events: DataFrame, path: str, checkpoint: str, key: str, time: str, delay: str, timeout_ms: int
) -> StreamingQuery:
    """Writes the changes of ``last_use`` batch by batch, each batch to a folder of its own number, so that a replayed batch replaces itself."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream = last_use(events, key, time, delay, timeout_ms).writeStream.outputMode("update").foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_use(spark: SparkSession, path: str) -> DataFrame:
    """``key, first_us, last_us, uses`` as the last batch that changed each key left it."""
    changes = spark.read.parquet(path).where("not ended")
    latest = changes.groupBy("key").agg(F.max_by(F.struct("first_us", "last_us", "uses"), "batch").alias("use"))
    return latest.select("key", "use.*")
