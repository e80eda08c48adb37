import pytest

from lakesteward.operators import grants
from lakesteward.sources.schemas import GRANTS


def frame(spark, *rows):
    return spark.createDataFrame([(i, "cat", who, sql) for i, (who, sql) in enumerate(rows)], GRANTS)


CASES = [
    ("GRANT INSERT, SELECT ON TABLE a.b TO ROLE r", ("SELECT,INSERT", "TABLE", "", "a", "b")),
    ("GRANT INSERT,SELECT ON TABLE a.b TO ROLE r", ("SELECT,INSERT", "TABLE", "", "a", "b")),
    ("GRANT CREATE TABLE ON DATABASE a TO ROLE r", ("CREATE TABLE", "DATABASE", "", "a", "")),
    ("grant  create   table , create on  database 'a' to role r", ("CREATE TABLE,CREATE", "DATABASE", "", "a", "")),
    ("GRANT SELECT ON ALL TABLES IN ALL DATABASES TO ROLE r", ("SELECT", "TABLE", "", "ALL DATABASES", "ALL TABLES")),
    ("GRANT SELECT ON ALL MATERIALIZED VIEWS IN DATABASE x TO ROLE r", ("SELECT", "MATERIALIZED VIEW", "", "x", "ALL MATERIALIZED VIEWS")),
    ("GRANT 'r1', 'r2' TO USER u", ("r1,r2", "ROLE", "", "", "")),
    ("GRANT USAGE ON RESOURCE GROUP g TO ROLE r", ("USAGE", "RESOURCE GROUP", "g", "", "")),
    ("GRANT USAGE ON ALL RESOURCES TO ROLE r", ("USAGE", "RESOURCE", "ALL RESOURCES", "", "")),
    ("GRANT USAGE ON ALL GLOBAL FUNCTIONS TO ROLE r", ("USAGE", "GLOBAL FUNCTION", "ALL GLOBAL FUNCTIONS", "", "")),
    ("GRANT ALL PRIVILEGES ON FUNCTION d.f(int) TO ROLE r", ("ALL", "FUNCTION", "", "d", "f(int)")),
    ("GRANT APPLY ON MASKING POLICY m IN DATABASE d TO ROLE r", ("APPLY", "MASKING POLICY", "m", "d", "")),
    ("GRANT DROP ON ALL MASKING POLICIES IN ALL DATABASES TO ROLE r", ("DROP", "MASKING POLICY", "ALL MASKING POLICIES", "ALL DATABASES", "")),
    ("GRANT OPERATE ON SYSTEM TO ROLE r", ("OPERATE", "SYSTEM", "", "", "")),
    ("GRANT SELECT ON a.b TO ROLE r", ("SELECT", "", "", "", "")),
    ("GRANT SELECTX ON TABLE a.b.c TO ROLE r", ("", "TABLE", "", "a", "b")),
]


def test_statements(spark):
    rows = grants.grant_flat(frame(spark, *[("r", sql) for sql, _ in CASES])).collect()
    found = {
        r["grant_sql"]: (",".join(r["permissions"]), r["object_type"], r["object_name"], r["object_db_name"], r["object_tbl_name"])
        for r in rows
    }
    assert found == dict(CASES)


@pytest.mark.parametrize("sql", ["GRANT SELECT ON TABLE nodot TO ROLE r", "GRANT APPLY ON MASKING POLICY m TO ROLE r"])
def test_rejects(spark, sql):
    assert grants.grant_flat(frame(spark, ("r", sql))).count() == 0
    assert grants.grant_rejects(frame(spark, ("r", sql))).count() == 1


def test_grantees(spark):
    rows = grants.grant_grantees(frame(spark, *[(w, "GRANT a TO b") for w in ("'u'@'%'", " r ", "a@b@c")])).orderBy("grant_id")
    assert [tuple(r)[1:] for r in rows.collect()] == [("USER", "u", "%"), ("ROLE", "r", ""), ("", "", "")]


def test_long_blanks_and_lists(spark):
    blanks = " " * 200_000
    many = ", ".join(["SELECT"] * 50_000)
    rows = grants.grant_flat(frame(
        spark, ("r", f"GRANT SELECT{blanks}ON TABLE a.b TO ROLE r"), ("r", f"GRANT {many} ON TABLE a.b{blanks}TO ROLE r"),
        ("r", f"GRANT SELECT ON TABLE a.b{blanks}"),
    )).collect()
    assert [r["permissions"] for r in rows] == [["SELECT"]] * 3


def test_good_and_rejects_cover_the_input(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    rows = fixture(spark, sf_dir, "grants").unionByName(frame(spark, ("r", "GRANT SELECT ON TABLE nodot TO r"), (None, None)))
    assert grants.grant_flat(rows).count() + grants.grant_rejects(rows).count() == rows.count()
    assert grants.grant_rejects(rows).count() == 1


def test_no_shuffle_and_one_scan(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    plan = grants.grant_flat(fixture(spark, sf_dir, "grants"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 0 and plan.count("FileScan") == 1
