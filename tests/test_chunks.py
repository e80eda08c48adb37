import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakesteward.operators.chunks import batch_process, chunk_rows, in_batches


def sizes(frame):
    return [r["count"] for r in frame.groupBy("chunk_id").count().orderBy("chunk_id").collect()]


@pytest.mark.parametrize("rows,size,expected", [(5, 2, [2, 2, 1]), (0, 2, []), (4, 2, [2, 2]), (3, 10, [3])])
def test_sizes(spark, rows, size, expected):
    assert sizes(chunk_rows(spark.range(rows), size, "id")) == expected


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    frame = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id")).repartition(partitions)
    rows = chunk_rows(frame, 64, "id").collect()
    assert all(r["position"] == r["id"] and r["chunk_id"] == r["id"] // 64 for r in rows) and len(rows) == 1000


def test_hot_key_and_copies_are_spread(spark):
    """Two thirds of the rows share their key and half of those are copies of one row."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, 5).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("v"),
    ).repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = chunk_rows(frame, 1000, "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sizes(numbered) == [1000] * 30
    assert numbered.select("position").distinct().count() == 30_000
    per_task = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 12_000
    low = numbered.where("position < 20000").agg(F.min("k"), F.max("k")).first()
    assert tuple(low) == (5, 5)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        chunk_rows(spark.range(1), 0, "id")
    with pytest.raises(ValueError):
        chunk_rows(spark.range(1), 1)


@pytest.mark.parametrize("frames,size", [([3, 4, 5], 4), ([10], 3), ([0, 1, 0, 1], 1), ([], 2), ([2, 2], 4), ([1, 1], 5)])
def test_in_batches(frames, size):
    start, parts = 0, []
    for n in frames:
        parts.append(pd.DataFrame({"x": range(start, start + n)}))
        start += n
    out = list(in_batches(iter(parts), size))
    assert [len(b) for b in out] == [size] * (start // size) + ([start % size] if start % size else [])
    assert [x for b in out for x in b["x"]] == list(range(start))


def test_batches_reach_every_callback(spark):
    def total(batch):
        return pd.DataFrame({"kind": ["sum"], "v": [int(batch["id"].sum())]})

    def count(batch):
        return pd.DataFrame({"kind": ["count"], "v": [len(batch)]})

    rows = batch_process(spark.range(0, 1000, 1, 4), 64, [total, count], "kind string, v bigint")
    found = dict(rows.groupBy("kind").sum("v").collect())
    assert found == {"sum": 499_500, "count": 1000}
    assert rows.where("kind = 'count'").agg(F.max("v")).first()[0] == 64
    assert batch_process(spark.range(0), 64, [count], "kind string, v bigint").count() == 0


def test_callback_error_stops(spark):
    def broken(batch):
        raise RuntimeError("no")

    with pytest.raises(Exception, match="no"):
        batch_process(spark.range(10), 4, [broken], "v bigint").count()
