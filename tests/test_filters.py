"""A filter on a result must not repeat the work that makes the result."""

import re
from datetime import datetime, timezone

import pytest

from lakesteward.operators import grants, inventory, policies
from lakesteward.plans.fixtures import fixture

AS_OF = datetime(2025, 1, 1, tzinfo=timezone.utc)
WORK = r"from_json\(|regexp_extract\(|regexp_extract_all\(|regexp_replace\(|RLIKE|Contains\("


def _work(df, pattern=WORK):
    """How often the optimized plan has a costly expression."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(pattern, plan))


def _listing(spark, sf_dir):
    return inventory.inventory_full(fixture(spark, sf_dir, "listing"), fixture(spark, sf_dir, "locations"))


JOBS = {
    "grant_flat": (lambda s, d: grants.grant_flat(fixture(s, d, "grants")), [
        "object_type = 'TABLE' and object_db_name = 'x'", "object_name = 'x'", "size(permissions) > 1", "grantee_type = 'USER' and ip = '%'"]),
    "pol_flat": (lambda s, d: policies.policy_flat(fixture(s, d, "policies"), AS_OF), [
        "object_type = 'TABLE'", "status", "object_name = 'x'", "policy_id = 3", "grantee = 'a' and permission_type = 'b'"]),
    "scan_policies": (lambda s, d: policies.scan_policies(fixture(s, d, "policies"), ["hive"]), ["doc.name = 'x'", "doc.id > 3"]),
    "inv_full": (_listing, ["is_table and db_name = 'a' and tbl_name = 'b'", "table_name = 'a.b'"]),
}


@pytest.mark.parametrize("name", JOBS)
def test_filters_add_no_work(spark, sf_dir, name):
    make, filters = JOBS[name]
    plain = make(spark, sf_dir)
    allowed = _work(plain)
    for condition in filters:
        assert _work(plain.where(condition)) <= allowed + 2, condition
    if name != "inv_full" and name != "grant_flat":
        assert _work(plain, r"from_json\(") == 1


def test_plain_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "grants")
    fixture(spark, sf_dir, "grants").write.parquet(path)
    flat = grants.grant_flat(spark.read.parquet(path)).where("grant_id = 3")
    assert "EqualTo(grant_id,3)" in flat._jdf.queryExecution().executedPlan().toString()
