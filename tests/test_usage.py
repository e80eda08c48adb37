import time

import pytest

from lakesteward.operators import usage
from lakesteward.sources.schemas import QUERY_LOG

LONG = "x" * 200_000


def log(spark, *queries, catalog="c", db="d"):
    return spark.createDataFrame([(i, catalog, db, q) for i, q in enumerate(queries)], QUERY_LOG)


CASES = [
    ("select * from T1 x join o.t2 y on 1=1", {"SELECT": ["c.d.t1", "c.o.t2"]}),
    ("select * from a x, b.c as y , e", {"SELECT": ["c.d.a", "c.b.c", "c.d.e"]}),
    ("select * from a,b", {"SELECT": ["c.d.a", "c.d.b"]}),
    ("select * from a my_alias, b as other_one, `x`.`y z` q", {"SELECT": ["c.d.a", "c.d.b", "c.x.y z"]}),
    ("select * from a assets, b", {"SELECT": ["c.d.a", "c.d.b"]}),
    ("with w as (select 1 from b) select * from w", {"SELECT": ["c.d.b"]}),
    ("select extract(year from ts) from t", {"SELECT": ["c.d.t"]}),
    ("delete from t where 1=1", {"DELETE": ["c.d.t"]}),
    ("select 'from x' from t -- from y", {"SELECT": ["c.d.t"]}),
    ("select \"from x\" from t /* from\n y **/ join /* a */ z", {"SELECT": ["c.d.t", "c.d.z"]}),
    ("select 'it''s \\' from q' from t", {"SELECT": ["c.d.t"]}),
    ("select 'two\nlines from x' from t", {"SELECT": ["c.d.t"]}),
    ("use db2; select * from t", {"SELECT": ["c.db2.t"]}),
    ("set catalog H; use h2.d2; select * from t", {"SELECT": ["h2.d2.t"]}),
    ("select * from t; use x; set catalog `Y`; ", {"SELECT": ["y.x.t"]}),
    ("use db2", {}),
    ("truncate table a.b.c.e", {}),
    ("insert into table t select 1", {"INSERT": ["c.d.table"]}),
    ("drop table if exists x.y", {"DROP": ["c.x.y"]}),
    ("drop temporary table tt", {"DROP": ["c.d.tt"]}),
    ("drop view `#tableau_1`", {}),
    ("create or replace view v as select 1", {}),
    ("create materialized view if not exists m.v as select * from s", {"CREATE": ["c.m.v"], "SELECT": ["c.d.s"]}),
    ("alter table a.b.c add column x int", {"ALTER": ["a.b.c"]}),
    ("update `t 1` set a = 1", {"UPDATE": ["c.d.t 1"]}),
    ("insert overwrite x.y select * from x.y join x.y", {"INSERT": ["c.x.y"], "SELECT": ["c.x.y"]}),
    ("select * from dual join UNNEST", {}),
    ("select * from  tablé join données", {"SELECT": ["c.d.tablé", "c.d.données"]}),
    ("select * from a . b where x in (select 1 from `q` . `r`)", {"SELECT": ["c.a.b", "c.q.r"]}),
]


@pytest.fixture(scope="module")
def found(spark):
    result = {}
    for r in usage.log_usage(log(spark, *[q for q, _ in CASES])).collect():
        name = f"{r['catalog']}.{r['db_name']}.{r['table_name']}"
        result.setdefault(r["query_id"], {}).setdefault(r["action"], []).append((r["index"], name))
    return result


@pytest.mark.parametrize("place", range(len(CASES)))
def test_usage(found, place):
    actions = {a: [n for _, n in sorted(rows)] for a, rows in found.get(place, {}).items()}
    assert actions == CASES[place][1]
    for rows in found.get(place, {}).values():
        assert sorted(i for i, _ in rows) == list(range(len(rows)))


def test_errors(spark):
    rows = usage.log_errors(log(spark, "truncate table a.b.c.e", "select * from t", db="")).collect()
    assert {(r["query_id"], r["action"], r["name"]) for r in rows} == {
        (0, "TRUNCATE", "`a`.`b`.`c`.`e`"), (1, "SELECT", "`t`"),
    }


def test_long_statements_survive(spark):
    many = ", ".join(f"t{i} a{i}" for i in range(20_000))
    texts = [
        f"select '{LONG}' from t", "select '" + "\\'" * 100_000 + "' from t", f"/* {LONG} */ select 1 from t",
        "select 1 from " + ".".join(["a"] * 100_000), f"select * from {many}", f"select 1 from `{LONG}`",
        "select '" + "\n" * 100_000 + "' from t",
    ]
    rows = usage.log_usage(log(spark, *texts)).groupBy("query_id").count().collect()
    assert dict(rows) == {0: 1, 1: 1, 2: 1, 4: 20_000, 5: 1, 6: 1}


def test_default_catalog(spark):
    rows = usage.log_usage(log(spark, "select * from t", catalog=" "), default="mine").collect()
    assert rows[0]["catalog"] == "mine"
    assert usage.log_default_catalog(log(spark, "x", catalog=" ")).first()["catalog"] == "default_catalog"


def test_extra_ignores(spark):
    texts = log(spark, "select * from S.T join u", "drop table old_x")
    rows = usage.log_usage(texts, ignore_tables=["s.t"], ignore_signs=["old_"]).collect()
    assert [(r["action"], r["table_name"]) for r in rows] == [("SELECT", "u")]


def test_clean_text(spark):
    text = "a 'b' -- c\n\n  \n/* d\n e */f \"g\"\\nh"
    keep = usage.log_clean(log(spark, text), drop_literals=False).first()["clean_query"]
    assert keep == "a 'b'  \nf \"g\"\nh"
    assert usage.log_clean(log(spark, text)).first()["clean_query"] == "a    \nf  \nh"


def test_no_shuffle_and_one_scan(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    plan = usage.log_usage(fixture(spark, sf_dir, "querylog"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 0 and plan.count("FileScan") == 1 and plan.count("Generate posexplode") == 1


HARD = {
    "extract": "extract(year ", "extract_from": "extract(a from ", "comment": "/* a ", "columns": ", b (y ", "quotes": "'a ", "back": "`a from ", "from": "from a, ",
    "double": '"x ', "escaped": "\\' ", "join": "join `a ", "with": "with a as ", "closed": "/*/ x */ ", "dashes": "-- a ",
}


@pytest.mark.parametrize("name", HARD)
def test_long_texts_take_time_in_proportion(spark, name):
    """A megabyte of openings that nothing closes stays quick, so the work cannot grow with the square."""
    took = []
    for size in (250_000, 1_000_000):
        text = ("x */ " if name == "comment" else "") + HARD[name] * (size // len(HARD[name]))
        rows = log(spark, text)
        start = time.perf_counter()
        usage.log_usage(rows).collect()
        took.append(time.perf_counter() - start)
    assert took[1] < 5 + 6 * took[0], took
