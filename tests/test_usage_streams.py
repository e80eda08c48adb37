from datetime import datetime, timedelta, timezone

import pytest

from lakesteward.sources.session import scratch_path
from lakesteward.streaming import jobs, usage

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "user_id long, at timestamp"


def _add(spark, path, rows):
    spark.createDataFrame([(k, START + timedelta(minutes=m)) for k, m in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _minutes(at):
    return round((at.replace(tzinfo=timezone.utc) - START).total_seconds() / 60)


def _run_sessions(spark, path, out, checkpoint):
    stream = jobs.stream_files(spark, path, SCHEMA)
    jobs.run_job(stream, lambda s: usage.usage_sessions(s, "user_id", "at", "30 minutes", "1 hour"), out, checkpoint).awaitTermination()
    read = spark.read.schema("user bigint, started timestamp, ended timestamp, events bigint").parquet(out)
    return sorted((r.user, _minutes(r.started), _minutes(r.ended), r.events) for r in read.collect())


def test_sessions_close_behind_the_watermark_and_late_rows_are_dropped(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    _add(spark, path, [(1, 0), (1, 20), (1, 60), (2, 5)])
    assert _run_sessions(spark, path, out, checkpoint) == []
    # Out of order, but not later than the delay; it joins the open session.
    _add(spark, path, [(1, 40), (1, 100)])
    assert _run_sessions(spark, path, out, checkpoint) == [(2, 5, 5, 1)]
    _add(spark, path, [(3, 1000)])
    closed = [(1, 0, 60, 4), (1, 100, 100, 1), (2, 5, 5, 1)]
    assert _run_sessions(spark, path, out, checkpoint) == closed
    # Behind the watermark: too late.
    _add(spark, path, [(1, 61), (4, 2000)])
    assert _run_sessions(spark, path, out, checkpoint) == [*closed, (3, 1000, 1000, 1)]


def test_sessions_of_a_table(spark):
    path = scratch_path(spark, "in")
    _add(spark, path, [(1, 0), (1, 29), (1, 60), (2, 5), (1, 0)])
    found = usage.usage_sessions(spark.read.parquet(path), "user_id", "at", "30 minutes").collect()
    assert sorted((r.user, _minutes(r.started), _minutes(r.ended), r.events) for r in found) == [(1, 0, 29, 3), (1, 60, 60, 1), (2, 5, 5, 1)]


pytest.importorskip("google.protobuf")


def _run_uses(spark, path, out, checkpoint, timeout_minutes=100_000):
    stream = jobs.stream_files(spark, path, SCHEMA, files_per_trigger=1)
    usage.run_last_use(spark, stream, out, checkpoint, "user_id", "at", "10 minutes", timeout_minutes * 60_000).awaitTermination()


def _state(spark, out):
    at = int(START.timestamp()) * 1_000_000
    return {r.key: ((r.first_us - at) // 60_000_000, (r.last_us - at) // 60_000_000, r.uses) for r in usage.latest_use(spark, out).collect()}


def test_last_use_survives_restarts_and_replays(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    _add(spark, path, [(1, 5), (1, 9), (2, 7)])
    _run_uses(spark, path, out, checkpoint)
    assert _state(spark, out) == {1: (5, 9, 2), 2: (7, 7, 1)}
    _add(spark, path, [(1, 30), (3, 31)])
    _run_uses(spark, path, out, checkpoint)
    expected = {1: (5, 30, 3), 2: (7, 7, 1), 3: (31, 31, 1)}
    assert _state(spark, out) == expected
    # Nothing new changes nothing; all of it from the start, into the same folder, gives the same.
    _run_uses(spark, path, out, checkpoint)
    assert _state(spark, out) == expected
    _run_uses(spark, path, out, scratch_path(spark, "checkpoint"))
    assert _state(spark, out) == expected


def test_last_use_times_out(spark):
    path, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "checkpoint"))
    _add(spark, path, [(1, 5), (2, 6)])
    _run_uses(spark, path, out, checkpoint, timeout_minutes=60)
    _add(spark, path, [(2, 50), (3, 90)])
    _run_uses(spark, path, out, checkpoint, timeout_minutes=60)
    ended = {r.key for r in spark.read.parquet(out).where("ended").collect()}
    assert ended == {1}
    _add(spark, path, [(1, 95)])
    _run_uses(spark, path, out, checkpoint, timeout_minutes=60)
    assert _state(spark, out)[1] == (95, 95, 1)
