import json
import os

import pytest
from pyspark.sql import functions as F

from lakesteward.sources import ledger, load
from lakesteward.sources.session import scratch_path

SCHEMA = "label string, row_count long, body string"


def _payloads(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _loaded(spark, path):
    return sorted(map(tuple, ledger.loaded_bodies(spark, path).collect()))


def test_a_repeated_load_changes_nothing(spark):
    path = scratch_path(spark, "loads")
    first = [(f"l{i}", 1, f"[{i}é]") for i in range(20)]
    ledger.load_once(_payloads(spark, first).repartition(4), path)
    assert _loaded(spark, path) == sorted(first)
    ledger.load_once(_payloads(spark, [(label, n, "[other]") for label, n, _ in first] + [("new", 2, "[x]")]), path)
    assert _loaded(spark, path) == sorted([*first, ("new", 2, "[x]")])
    ledger.load_once(_payloads(spark, []), path)
    assert len(_loaded(spark, path)) == 21


def test_bodies_of_failed_and_repeated_tasks_do_not_count(spark):
    path = scratch_path(spark, "loads")
    writer = ledger.LabelledWriter(path)
    batch = _payloads(spark, [("a", 1, "[1]"), ("b", 1, "[2]")]).toArrow().to_batches()
    lost = writer.write(iter(batch))
    again = writer.write(iter(batch))
    assert ledger.ledger(spark, path).count() == 0
    writer.commit([again, None])
    assert len(os.listdir(f"{path}/bodies".replace("file:", ""))) == 2
    assert _loaded(spark, path) == [("a", 1, "[1]"), ("b", 1, "[2]")]
    writer.abort([lost])
    assert len(os.listdir(f"{path}/bodies".replace("file:", ""))) == 1
    # Two commits of the same labels, as by two drivers at once: one counts.
    other = writer.write(iter(batch))
    writer.commit([other])
    assert _loaded(spark, path) == [("a", 1, "[1]"), ("b", 1, "[2]")]


def test_a_load_that_fails_leaves_no_label(spark):
    path = scratch_path(spark, "loads")
    bad = spark.range(40, numPartitions=4).select(
        F.concat(F.lit("l"), F.col("id")).alias("label"), F.lit(1).cast("long").alias("row_count"),
        F.when(F.col("id") == 33, F.raise_error(F.lit("broken"))).otherwise(F.lit("[]")).alias("body"),
    )
    with pytest.raises(Exception, match="broken"):
        ledger.load_once(bad, path)
    assert ledger.ledger(spark, path).count() == 0
    ledger.load_once(bad.where("id <> 33"), path)
    assert len(_loaded(spark, path)) == 39


def test_a_damaged_body_is_reported(spark):
    path = scratch_path(spark, "loads")
    ledger.load_once(_payloads(spark, [("a", 1, "[1]")]), path)
    folder = f"{path}/bodies".replace("file:", "")
    with open(f"{folder}/{os.listdir(folder)[0]}", "r+b") as file:
        file.write(b"X")
    with pytest.raises(Exception, match="damaged"):
        _loaded(spark, path)


@pytest.mark.parametrize("most", [30, 100, 1000])
def test_bodies_stay_below_their_bytes(spark, most):
    rows = spark.range(300).selectExpr("id", "repeat('é', CAST(id % 23 AS INT)) AS t", "if(id % 50 = 7, repeat('x', 2000), '') AS big")
    found = load.load_payloads(rows, "d", "t", ["id", "t", "big"], ["id"], 90, "b", most).collect()
    assert len({r.label for r in found}) == len(found)
    held = [json.loads(r.body) for r in found]
    assert sorted(x["id"] for body in held for x in body) == list(range(300))
    for r, body in zip(found, held):
        assert r.row_count == len(body) <= 90
        assert len(r.body.encode()) <= most or len(body) == 1
    again = load.load_payloads(rows.repartition(3), "d", "t", ["id", "t", "big"], ["id"], 90, "b", most).collect()
    assert {(r.label, r.body) for r in again} == {(r.label, r.body) for r in found}
