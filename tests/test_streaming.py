"""A job gives the same rows on a stream as on a table."""

from collections import Counter

import pytest

from lakesteward.operators import grants, inventory, policies, usage
from lakesteward.plans.fixtures import fixture
from lakesteward.plans.registry import AS_OF
from lakesteward.sources.session import scratch_path
from lakesteward.streaming.jobs import each_batch, run_job, stream_files

JOBS = {
    "listing": inventory.inventory_full,
    "grants": grants.grant_flat,
    "querylog": usage.log_usage,
    "policies": lambda rows: policies.policy_flat(rows, AS_OF),
}


def bag(frame):
    return Counter(str(r) for r in frame.collect())


@pytest.mark.parametrize("name", list(JOBS))
def test_stream_equals_batch(spark, sf_dir, name):
    rows = fixture(spark, sf_dir, name)
    folder, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows.repartition(4).write.parquet(folder)
    stream = stream_files(spark, folder, rows.schema, files_per_trigger=1)
    query = run_job(stream, JOBS[name], out, scratch_path(spark, "state"))
    query.awaitTermination(120)
    assert bag(spark.read.parquet(out)) == bag(JOBS[name](rows))


def test_each_batch(spark):
    folder = scratch_path(spark, "in")
    spark.range(0, 100, 1, 4).write.parquet(folder)
    seen, totals = [], []
    query = each_batch(
        stream_files(spark, folder, "id bigint", files_per_trigger=2),
        [lambda b, i: seen.append((i, b.count())), lambda b, i: totals.append(b.groupBy().sum("id").first()[0])],
        scratch_path(spark, "state"),
    )
    query.awaitTermination(120)
    assert sum(n for _, n in seen) == 100 and len(seen) == 2 and sum(totals) == 4950
