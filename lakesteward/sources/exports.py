"""Readers of JSON exports: policies, service definitions and users as a service writes them, one array in a file.

An array of any length is read by several tasks. Where a byte range starts cannot be told from its own bytes, since it may lie inside
a text, so there are two passes. The first one takes down, for each range, how many quotes it has and how far it opens or
closes brackets, once for either state it may start in; running sums over a file's ranges then give every range its state and depth. The second pass reads the
documents that start in a range, and follows the last one beyond its end. Bodies go to ``from_json`` with the nested schemas.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import POLICY, SERVICE_DEFINITION, USERS

RANGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
# First step by which a document is followed beyond the end of its range; each further one is twice as long.
TAIL_BYTES = 4 << 10
# Bytes that one task is meant to read. Short ranges share a task, long ones have one each.
TASK_BYTES = 16 << 20
MAX_TASKS = 10_000
# How deep documents lie: one to a line, in an array, in an array that a field of one object holds.
DEPTHS = {"lines": 0, "array": 1, "wrapped": 2}

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    uri = path if "://" in path else "file://" + path.removeprefix("file:") if path.startswith(("/", "file:")) else path
    return fs.FileSystem.from_uri(uri)


def _escaped_before(file, start: int) -> bool:
    """Whether an odd number of backslashes ends just before ``start``."""
    count, at = 0, start
    while at:
        low = max(0, at - 4096)
        file.seek(low)
        part = file.read(at - low)
        bare = len(part.rstrip(b"\\"))
        count += len(part) - bare
        if bare:
            break
        at = low
    return count % 2 == 1


def _quotes(data: np.ndarray, escaped: bool) -> np.ndarray:
    """Places of quotes that no backslash escapes."""
    quotes = np.flatnonzero(data == ord('"'))
    if not len(quotes):
        return quotes
    other = np.flatnonzero(data != ord("\\"))
    # Backslashes right before a quote: those behind the last other byte.
    at = np.searchsorted(other, quotes) - 1
    run = quotes - np.where(at >= 0, other[at], -1) - 1
    return quotes[(run + np.where((at < 0) & escaped, 1, 0)) % 2 == 0]


def _blocks(file, start: int, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(place, bytes, unescaped quotes)`` of a byte range, some megabytes at a time."""
    escaped, at = _escaped_before(file, start), start
    while at < end:
        file.seek(at)
        raw = file.read(min(READ_BYTES, end - at))
        if not raw:
            return
        data = np.frombuffer(raw, np.uint8)
        yield at, data, _quotes(data, escaped)
        tail = len(raw) - len(raw.rstrip(b"\\"))
        escaped = (tail + (escaped if tail == len(raw) else 0)) % 2 == 1
        at += len(raw)


def _range_and_tail(file, start: int, end: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of a range, and of what follows it in growing steps, as far as they are asked for."""
    yield from _blocks(file, start, end)
    at, step = end, TAIL_BYTES
    while at < size:
        yield from _blocks(file, at, min(at + step, size))
        at += step
        step = min(2 * step, READ_BYTES)


def _inside(size: int, quotes: np.ndarray, start: bool) -> np.ndarray:
    """Which bytes lie inside a text; the quotes themselves count to either side."""
    flips = np.zeros(size, np.int8)
    flips[quotes] = 1
    return (np.cumsum(flips, dtype=np.int64) + int(start)) % 2 == 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range the number of quotes, and its change of depth if it starts outside and if it starts inside a text."""
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            store, path = _opened(row["file"])
            quotes, change = 0, [0, 0]
            with store.open_input_file(path) as file:
                for _, data, marks in _blocks(file, row["start"], row["end"]):
                    step = _STEP[data].astype(np.int64)
                    held = _inside(len(data), marks, quotes % 2 == 1)
                    change[0] += int(step[~held].sum())
                    change[1] += int(step[held].sum())
                    quotes += len(marks)
            row.update(quotes=quotes, outside=change[0], within=change[1])
        yield pa.RecordBatch.from_pylist(rows, pa.schema([
            ("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("quotes", pa.int64()), ("outside", pa.int64()), ("within", pa.int64()),
        ]))


def _documents(file, start: int, end: int, inside: bool, depth: int, level: int) -> Iterator[tuple[int, bytes]]:
    """Documents that start in a range: objects whose opening bracket leads from ``level`` one deeper. Beyond the range only its last one is read."""
    begun, held = None, []
    for at, data, quotes in _range_and_tail(file, start, end, file.size()):
        text = _inside(len(data), quotes, inside)
        step = np.where(text, 0, _STEP[data]).astype(np.int64)
        after = depth + np.cumsum(step)
        opens = np.flatnonzero((step == 1) & (after == level + 1) & (data == ord("{")))
        closes = np.flatnonzero((step == -1) & (after == level) & (data == ord("}")))
        from_ = 0
        if begun is not None and len(closes):
            held.append(data[:closes[0] + 1].tobytes())
            yield begun, b"".join(held)
            begun, held = None, []
        for first in opens.tolist():
            if at + first >= end:
                break
            last = closes[np.searchsorted(closes, first):][:1]
            if len(last):
                yield at + first, data[first:last[0] + 1].tobytes()
            else:
                begun, from_ = at + first, first
        if begun is not None:
            held.append(data[from_:].tobytes())
        inside, depth = bool(text[-1]), int(after[-1])
        if at + len(data) >= end and begun is None:
            return
    if begun is not None:
        yield begun, b"".join(held)


def _reader(level: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _opened(row["file"])
                places, bodies, size = [], [], 0
                with store.open_input_file(path) as file:
                    found = _documents(file, row["start"], row["end"], row["inside"], row["depth"], level)
                    for place, body in found:
                        places.append(place)
                        bodies.append(body.decode("utf-8", "replace"))
                        size += len(body)
                        if size >= READ_BYTES:
                            yield _rows(row["file"], places, bodies)
                            places, bodies, size = [], [], 0
                if places:
                    yield _rows(row["file"], places, bodies)

    return read


def _rows(file: str, places: list[int], bodies: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * len(places)), pa.array(places, pa.int64()), pa.array(bodies, pa.string())], names=["file", "place", "body"]
    )


def read_documents(spark: SparkSession, path: str, layout: str = "array", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, place, body`` of every document in the files of a path; ``place`` is its first byte in the file.

    ``layout`` says where documents lie: ``array``, ``wrapped`` (arrays in the fields of one object) or ``lines``. What is no object is left out. An
    unfinished document at the end of a file comes as it is, so that its parse fails and it counts as a reject.
    """
    level = DEPTHS[layout]
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length").where("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    ranges = files.select("file", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("file", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))
    measured = ranges.agg(F.count("*").alias("count"), F.sum(F.col("end") - F.col("start")).alias("bytes")).first()
    # A task costs more than a short range does, so tasks go by bytes; every core has one, as far as there are ranges.
    wanted = max(spark.sparkContext.defaultParallelism, -(-(measured["bytes"] or 0) // TASK_BYTES))
    tasks = max(1, min(measured["count"], wanted, MAX_TASKS))
    apart = ranges.repartition(tasks, "file", "start")
    told = apart.mapInArrow(_summaries, "file string, start long, end long, quotes long, outside long, within long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    flipped = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    placed = told.withColumn("inside", flipped)
    placed = placed.withColumn("change", F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside")))
    placed = placed.withColumn("depth", F.coalesce(F.sum("change").over(before), F.lit(0)))
    states = placed.select("file", "start", "end", "inside", "depth").repartition(tasks, "file", "start")
    return states.mapInArrow(_reader(level), "file string, place long, body string")


def read_policies(spark: SparkSession, path: str, layout: str = "array", **options) -> DataFrame:
    """``id, body`` of exported policies, for the policy jobs; ``id`` is null where a body is not readable."""
    documents = read_documents(spark, path, layout, **options)
    return documents.select(F.from_json("body", POLICY)["id"].alias("id"), "body")


def read_definitions(spark: SparkSession, path: str, layout: str = "wrapped", **options) -> DataFrame:
    """Exported service definitions, nested as they are."""
    parsed = read_documents(spark, path, layout, **options).select(F.from_json("body", SERVICE_DEFINITION).alias("doc"))
    return parsed.select("doc.*")


def read_users(spark: SparkSession, path: str, layout: str = "wrapped", **options) -> DataFrame:
    """Exported user records with ``seq``, their order in the export."""
    parsed = read_documents(spark, path, layout, **options).select("file", "place", F.from_json("body", USERS).alias("doc"))
    return parsed.select("doc.*", F.struct("file", "place").alias("seq"))


def write_export(rows: DataFrame, path: str, field: str | None = None) -> None:
    """JSON documents of the ``body`` column as files that hold one array each, in an object's ``field`` if it is given."""
    head = '{"startIndex":0,"' + field + '":[' if field else "["
    tail = '],"resultSize":0}' if field else "]"

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            out = []
            for body in batch.column(0).to_pylist():
                out.append((head if first else ",") + body)
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array([head + tail if first else tail])], names=["value"])

    rows.select("body").mapInArrow(lines, "value string").write.text(path)
