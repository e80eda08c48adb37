import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lakesteward.operators import policies

AS_OF = datetime(2025, 1, 1, tzinfo=timezone.utc)
ENDED = {"startTime": "2020/01/02 00:00:00", "endTime": "2021/1/2 9:5:3", "timeZone": "Asia/Shanghai"}
OPEN = {"startTime": "2020/1/2 3:4:5", "endTime": "2099/12/31 23:59:59", "timeZone": ""}
FUTURE = {"startTime": "2030/1/1 0:0:0", "endTime": "2099/12/31 23:59:59", "timeZone": "UTC"}
ITEM = {"users": ["u"], "groups": [], "roles": [], "accesses": [{"type": "select", "isAllowed": True}]}


def body(**fields):
    doc = {"id": 1, "name": "p", "isEnabled": True, "policyPriority": 0, "serviceType": "hive",
           "resources": {"database": {"values": ["d"]}}, "policyItems": [ITEM]}
    doc.update(fields)
    return json.dumps({k: v for k, v in doc.items() if v is not None})


def frame(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


def flat(spark, *bodies):
    return policies.policy_flat(frame(spark, *bodies), AS_OF).collect()


def values(**kinds):
    return {k: {"values": v} for k, v in kinds.items()}


@pytest.mark.parametrize("schedules,status", [
    ([OPEN, ENDED], False), ([ENDED, OPEN], True), ([FUTURE], True), ([], True), (None, True),
])
def test_schedules(spark, schedules, status):
    assert [r["status"] for r in flat(spark, body(validitySchedules=schedules))] == [status]


def test_zone_decides(spark):
    def ending(zone):
        return [{"startTime": "2020/1/1 0:0:0", "endTime": "2025/1/1 4:0:0", "timeZone": zone}]

    assert [r["status"] for r in flat(spark, body(validitySchedules=ending("UTC")))] == [True]
    assert [r["status"] for r in flat(spark, body(validitySchedules=ending("Asia/Shanghai")))] == [False]


def test_validity_text(spark):
    rows = policies.policy_validity(frame(spark, body(validitySchedules=[ENDED])).withColumn("id", policies.F.lit(1))).collect()
    assert rows[0]["validity"] == "2020-01-02 00:00:00~2021-01-02 09:05:03~Asia/Shanghai"


@pytest.mark.parametrize("fields,status", [
    ({"isEnabled": False}, {"PolicyItem": False}),
    ({"policyItems": None, "allowExceptions": [ITEM]}, {"AllowException": False}),
    ({"allowExceptions": [ITEM]}, {"PolicyItem": True, "AllowException": True}),
    ({"policyItems": None, "denyExceptions": [ITEM]}, {"DenyException": False}),
    ({"denyPolicyItems": [ITEM], "denyExceptions": [ITEM]}, {"PolicyItem": True, "DenyPolicyItem": True, "DenyException": True}),
])
def test_status(spark, fields, status):
    assert {r["permission_type"]: r["status"] for r in flat(spark, body(**fields))} == status


@pytest.mark.parametrize("names,expected", [([" "], []), (["", ""], ["", ""]), ([" a ", ""], ["a", ""]), ([], [])])
def test_blank_grantees(spark, names, expected):
    item = {**ITEM, "users": [], "groups": names}
    assert [r["grantee"] for r in flat(spark, body(policyItems=[item]))] == expected


@pytest.mark.parametrize("service,resources,expected", [
    ("cos", values(bucket=["b", "*"], path=["/p", "*"]),
     {("COS", n, "", "") for n in ("b AND /p", "b AND ALL PATH", "ALL BUCKET AND /p", "ALL BUCKET AND ALL PATH")}),
    ("yarn", values(queue=["q", "*"]), {("YARN", "q", "", ""), ("YARN", "ALL QUEUE", "", "")}),
    ("hive", values(database=["*"]), {("DATABASE", "", "ALL DATABASE", "")}),
    ("hive", values(database=["d"], table=["t", "*"]), {("TABLE", "", "d", "t"), ("TABLE", "", "d", "ALL TABLE")}),
    ("hive", values(udf=["f"], **{"global": ["g"]}), {("GLOBAL UDF", "g", "", "")}),
    ("hive", values(hiveservice=["*"]), {("HIVE SERVICE", "ALL HIVE SERVICE", "", "")}),
])
def test_objects(spark, service, resources, expected):
    rows = flat(spark, body(serviceType=service, resources=resources))
    assert {(r["object_type"], r["object_name"], r["object_db_name"], r["object_tbl_name"]) for r in rows} == expected
    assert len(rows) == len(expected)


def test_columns_stay_together(spark):
    rows = flat(spark, body(resources=values(database=["d"], table=["t"], column=["a", "b"])))
    assert [(r["object_type"], r["object_column"]) for r in rows] == [("COLUMN", ["a", "b"])]


def test_mask_takes_the_first_names(spark):
    mask = {**ITEM, "dataMaskInfo": {"dataMaskType": "HASH"}}
    resources = values(database=["*", "d"], table=["t", "*"], column=["c"])
    rows = flat(spark, body(resources=resources, dataMaskPolicyItems=[mask], policyItems=None))
    assert [(r["object_type"], r["object_db_name"], r["object_tbl_name"], r["object_restriction"]) for r in rows] == [
        ("MASKING", "*", "t", ["HASH"])
    ]


@pytest.mark.parametrize("bad,reason", [
    (body(serviceType="kms", resources=values(keyname=["k"])), "unsupported object"),
    (body(resources=values(database=["a", "b"], udf=["f"])), "unsupported object"),
    (body(serviceType="HIVE"), "unsupported object"),
    (body(rowFilterPolicyItems=[{**ITEM, "rowFilterInfo": {"filterExpr": "x"}}]), "no database or table"),
    (body(validitySchedules=[{**OPEN, "endTime": "soon"}]), "bad schedule"),
    (body(validitySchedules=[{**OPEN, "timeZone": "Mars/Base"}]), "bad schedule"),
    (body(validitySchedules=[{**OPEN, "endTime": "2021/13/1 0:0:0"}]), "bad schedule"),
    ("{not json", "unreadable document"),
])
def test_rejects(spark, bad, reason):
    rows = policies.policy_rejects(frame(spark, bad, body()), AS_OF).collect()
    assert [(r["body"], r["reject_reason"]) for r in rows] == [(bad, reason)]
    assert len(flat(spark, bad, body())) == 1


def test_override_and_filters(spark):
    bodies = frame(spark, body(policyPriority=1), body(id=2))
    rows = policies.policy_flat(bodies, AS_OF, [lambda d: d.where("is_override"), lambda d: d.select("policy_id")]).collect()
    assert [tuple(r) for r in rows] == [(1,)]


def test_ids_and_services(spark):
    docs = spark.createDataFrame([(1, body()), (2, body(serviceType="Yarn")), (3, body(serviceType="atlas"))], "id int, body string")
    assert [r["id"] for r in policies.policies_by_id(docs, [1, 3]).orderBy("id").collect()] == [1, 3]
    with pytest.raises(ValueError):
        policies.policies_by_id(docs, [])
    assert {r["id"] for r in policies.scan_policies(docs).collect()} == {1, 2}
    assert policies.scan_policies(docs, ["nope"]).count() == 0


def test_one_scan_no_shuffle(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    plan = policies.policy_flat(fixture(spark, sf_dir, "policies"), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 0 and plan.count("FileScan") == 1


@pytest.mark.parametrize("partitions", [1, 9])
def test_rows_do_not_depend_on_partitions(spark, sf_dir, partitions):
    from lakesteward.plans.fixtures import fixture

    rows = fixture(spark, sf_dir, "policies")
    split = policies.policy_flat(rows.repartition(partitions), AS_OF)
    whole = policies.policy_flat(rows, AS_OF)
    assert split.exceptAll(whole).count() == 0 and split.count() == whole.count()
    kept = policies.policy_expired(rows, AS_OF).count()
    assert kept + policies.policy_rejects(rows, AS_OF).count() == rows.count()


def test_ids_without_a_policy_are_told(spark):
    held = spark.createDataFrame([(1, "{}"), (2, "{}")], "id int, body string")
    ids = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id int")
    assert [r.id for r in policies.missing_policies(held, ids).collect()] == [3]
    assert policies.missing_policies(held, ids.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["pol_items", "pol_flat", "pol_object_type", "pol_validity_text"])
def test_policies_of_one_row_group_are_parsed_by_several_tasks(spark, sf_dir, name):
    from lakesteward.plans.registry import QUERIES

    rows = QUERIES[name](spark, sf_dir)
    per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 4 and max(per_task) < sum(per_task) / 2
    # Only the key that the policies are made from moves.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Project [c_custkey" in plan.split("Repartition")[1]
