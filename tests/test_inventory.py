import random

import pytest
from pyspark.sql import functions as F

from lakesteward.operators import inventory
from lakesteward.sources.schemas import LISTING


def listing(spark, rows):
    full = [(n, "a", "m", "c", size, t, "acl", "u", "g", "STANDARD", dt) for n, t, size, dt in rows]
    return spark.createDataFrame(full, LISTING)


def one(spark, name, kind, job=inventory.inventory_slim):
    return job(listing(spark, [(name, kind, 5, "2024-01-02")])).collect()


EDGES = [
    ("/", "DIR", {"path_level": 0, "extend_level0_name": "/", "extend_level1_name": ""}),
    ("/tmp", "FILE", {"path_level": 1, "extend_level1_name": ""}),
    ("/tmp", "DIR", {"path_level": 1, "extend_level1_name": "tmp"}),
    ("/user/hive/warehouse/X.DB", "DIR", {"extend_level4_name": "X.DB", "db_name": "", "table_name": ""}),
    ("/user/hive/warehouse/X.DB/", "DIR", {"db_name": "x", "tbl_name": "", "table_name": "x.", "path_level": 5}),
    ("/user/hive/warehouse/x.db/T/dt=1/f/g", "FILE",
     {"path_level": 8, "extend_level5_name": "T", "extend_level6_name": "", "tbl_name": "t"}),
    ("/user/hive/warehouse/x.db/T/dt=1/f/g", "DIR", {"extend_level6_name": "dt=1"}),
    ("/user/hive/warehouse/x.db/f.txt", "FILE",
     {"extend_level4_name": "x.db", "extend_level5_name": "", "tbl_name": "f.txt"}),
    ("/a/b/c/my.dbase.DB/T", "DIR", {"db_name": "myase", "tbl_name": "t"}),
]


@pytest.mark.parametrize("name,kind,expected", EDGES)
def test_attribution(spark, name, kind, expected):
    row = one(spark, name, kind)[0].asDict()
    assert {k: row[k] for k in expected} == expected


@pytest.mark.parametrize("name,kind", [("plainname", "FILE"), ("/a/b", "dir"), ("/a/b", "LINK"), (None, "FILE"), ("/a/b", None)])
def test_rejects(spark, name, kind):
    assert one(spark, name, kind) == []
    assert len(one(spark, name, kind, inventory.inventory_rejects)) == 1


def test_bad_date_and_columns(spark):
    rows = inventory.inventory_full(listing(spark, [("/a/b", "DIR", 1, "bad"), ("/a/c", "DIR", None, "2024-01-02")]))
    assert rows.columns == inventory.FULL_COLUMNS
    found = {r["name"]: (r["dt"] and str(r["dt"]), r["size"]) for r in rows.collect()}
    assert found == {"/a/b": (None, 1), "/a/c": ("2024-01-02", 0)}


LOCATIONS = [
    ("/ext/tbl_1", "Ext.T1"), ("/ext/tbl_12", "Ext.T12"), ("/EXT/other", "Ext.Other.more"), ("/ext/z[0-9]+", "Ext.Z"),
    ("/nodot", "nodot"), ("/w.db/t", "Dot.T"), ("/ext/same", "A.b"), ("/ext/same", "B.a"),
]
NAMES = ["/ext/tbl_1/f", "/ext/tbl_12/f", "/ext/tbl_123/f", "/x/ext/OTHER/f", "/ext/z77/f", "/nodot/f", "/a/W-DB/T", "/a/wdb/t", "/EXT/\u017fame", "/ext/same/f", "/ext/none"]


@pytest.mark.parametrize("limit", [inventory.PLAN_PATTERNS, 0])
def test_pattern_routes_agree(spark, limit):
    rows = listing(spark, [(n, "FILE", 1, "") for n in NAMES * 3])
    places = spark.createDataFrame(LOCATIONS, "pattern string, table_name string")
    found = inventory.attach_pattern_owner(rows, places, limit).select("name", "_table").collect()
    assert len(found) == 3 * len(NAMES)
    assert dict(found) == {
        "/ext/tbl_1/f": "Ext.T1", "/ext/tbl_12/f": "Ext.T12", "/ext/tbl_123/f": "Ext.T12", "/x/ext/OTHER/f": "Ext.Other.more",
        "/ext/z77/f": "Ext.Z", "/nodot/f": None, "/a/W-DB/T": "Dot.T", "/a/wdb/t": None, "/EXT/\u017fame": "A.b", "/ext/same/f": "A.b", "/ext/none": None,
    }
    owned = {r["name"]: r for r in inventory.match_locations(rows, places).collect()}
    assert owned["/x/ext/OTHER/f"]["tbl_name"] == "Other" and owned["/x/ext/OTHER/f"]["is_table"]


def test_many_patterns_in_batches(spark):
    count = 700
    rows = listing(spark, [(f"/lake/t{i:04d}/f", "FILE", 1, "") for i in range(0, count, 7)])
    places = spark.range(count).selectExpr("format_string('/t%04d/', id) AS pattern", "concat('d.t', id) AS table_name")
    found = dict(inventory.attach_pattern_owner(rows, places).select("name", "_table").collect())
    assert found == {f"/lake/t{i:04d}/f": f"d.t{i}" for i in range(0, count, 7)}


ODD_NAMES = ["/ext/zip/f", "/ext/z\u0131p/f", "/EXT/Z\u0130P/f", "/ext/\u017fafe/k/f", "/ext/safe/\u212a/f", "/x/(", "/a+b/c", "/a/b/c", "/ext/a.b/f", "/ext/axb/f", "/\u0130d/f"]
ODD_PATTERNS = [("/ext/zip/", "a.zip"), ("/ext/safe/k/", "a.safe"), ("(", "a.bad"), ("[z", "a.bad2"), ("/x", "c.d"), (r"/a\+b/", "a.plus"), ("/A/(b|q)/", "a.alt"),
                ("/ext/a.b/", "a.dot"), ("i\u0307?d/", "a.i"), ("\u0130d", "a.dotted"), ("/ext/", "a.ext"), ("a", "nodot"), (None, "a.b")]


def test_one_answer_at_every_size(spark):
    places = spark.createDataFrame(ODD_PATTERNS, "pattern string, table_name string")
    rows = listing(spark, [(n, "FILE", 1, "") for n in ODD_NAMES * 2])
    found = [sorted(inventory.attach_pattern_owner(rows, places, limit).select("name", "_table").collect()) for limit in (512, 3, 0)]
    assert found[0] == found[1] == found[2]
    owners = dict(found[0])
    assert owners["/ext/zip/f"] == "a.zip" and owners["/ext/z\u0131p/f"] == owners["/EXT/Z\u0130P/f"] == "a.ext"
    assert owners["/ext/\u017fafe/k/f"] == owners["/ext/safe/\u212a/f"] == "a.safe"
    assert owners["/x/("] == "c.d" and owners["/a+b/c"] == "a.plus" and owners["/a/b/c"] == "a.alt" and owners["/\u0130d/f"] == "a.dotted"
    assert sorted(r["table_name"] for r in inventory.unusable_locations(places).collect()) == ["a.b", "a.bad", "a.bad2", "nodot"]


def test_empty_locations(spark):
    places = spark.createDataFrame([], "pattern string, table_name string")
    rows = listing(spark, [("/a/b/c/x.db/T", "DIR", 1, "")])
    for job in (inventory.match_locations, inventory.match_location_prefixes):
        assert job(rows, places).first().asDict() == {
            "name": "/a/b/c/x.db/T", "table_name": "x.t", "db_name": "x", "tbl_name": "t", "is_table": False,
        }


@pytest.mark.parametrize("limit", [inventory.BROADCAST_LOCATIONS, 0])
def test_prefix_routes_agree(spark, limit):
    names = ["/ext/t1/f", "/ext/t1", "/EXT/T1/sub/f", "/ext/t12/f", "/ext/deep/er/f", "/ext/deep/x", "/"]
    rows = listing(spark, [(n, "FILE", 1, "") for n in names * 2])
    places = spark.createDataFrame(
        [("/ext/t1/", "a.t1"), ("/ext/deep", "a.deep"), ("/ext/deep/er", "a.deeper"), ("/", "a.root")],
        "pattern string, table_name string",
    )
    found = inventory.attach_prefix_owner(rows, places, limit).select("name", "_table").collect()
    assert len(found) == 2 * len(names)
    assert dict(found) == {
        "/ext/t1/f": "a.t1", "/ext/t1": "a.t1", "/EXT/T1/sub/f": "a.t1", "/ext/t12/f": None,
        "/ext/deep/er/f": "a.deeper", "/ext/deep/x": "a.deep", "/": None,
    }


def test_good_and_rejects_cover_the_input(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    rows = fixture(spark, sf_dir, "listing")
    total = inventory.inventory_slim(rows).count() + inventory.inventory_rejects(rows).count()
    assert total == rows.count()


def test_small_catalogue_does_not_shuffle_the_listing(spark, sf_dir):
    from lakesteward.plans.fixtures import fixture

    rows, places = fixture(spark, sf_dir, "listing"), fixture(spark, sf_dir, "locations")
    for job in (inventory.inventory_full, inventory.match_locations):
        plan = job(rows, places)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 0


def test_pieces_of_patterns_try_few_pairs(spark):
    """Patterns without a whole folder meet only paths with their rarest piece."""
    names = spark.range(3000).selectExpr("concat('/lake/area', id % 30, '/tab_', id) AS _name").withColumn("_folded", F.col("_name"))
    patterns = spark.createDataFrame(
        [(f"Tab_{i}", f"d.t{i}") for i in range(1000, 1500)] + [("area7/tab.7", "d.a"), ("nowhere_at_all", "d.n"), ("lake/", "d.l")], "pattern string, table_name string"
    )
    pairs = inventory.gram_pairs(names, patterns)
    tried = {r.pattern: r.n for r in pairs.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    assert "nowhere_at_all" not in tried and tried["lake/"] == 3000 and tried["area7/tab.7"] <= 100
    # One path in all holds "_1000" to "_1499", and some more hold its shorter pieces.
    assert sum(n for p, n in tried.items() if p.startswith("Tab_")) < 20 * 500


def test_pieces_give_what_trying_all_gives(spark):
    rng = random.Random(2)
    parts = ["alpha", "beta.db", "Gamma_1", "delta", "ab", "ıİk", "x-y"]
    rows = [("/" + "/".join(rng.choices(parts, k=rng.randrange(1, 6))) + str(rng.randrange(40)), "DIR", 1, "") for _ in range(300)]
    texts = ["pha/be", "a.db/g", "MMA_1", "b", "x.y/del", "ta1", "lpha.beta", "delta2", "a/ab", "nothing", "(alpha|x)/", "amma.1.d"]
    locations = spark.createDataFrame([(t, f"d.t{i}") for i, t in enumerate(texts)], "pattern string, table_name string")
    rows = listing(spark, rows)
    found = [
        sorted((r.name, r.table_name, r.is_table) for r in inventory.match_locations(rows, locations, plan_patterns=n).collect()) for n in (512, 0, 3)
    ]
    assert found[0] == found[1] == found[2] and sum(r[2] for r in found[0]) > 50


@pytest.mark.parametrize("rows", [0, 500_000])
def test_few_owners_and_pieces_move_no_paths(spark, monkeypatch, rows):
    """Pieces of paths and the listing stay where they are if what they meet is small; the rows are the same if it is not."""
    monkeypatch.setattr(inventory, "BROADCAST_LOCATIONS", rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As for tables that the engine takes for large.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        listing = spark.range(400).selectExpr("concat('/a/b/Zone', id % 7, '/Tbl_', id) AS name", "'DIR' AS type", "1L AS size_byte")
        found = [(f"zone{i % 7}/tbl_{i}", f"d.t{i}") for i in range(390, 420)]
        locations = spark.createDataFrame(found + [(f"nowhere{i}", f"d.n{i}") for i in range(30)], "pattern string, table_name string")
        matched = inventory.match_locations(listing, locations, plan_patterns=1)
        names = listing.select(F.col("name").alias("_name"), F.lower("name").alias("_folded"))
        pairs = inventory.gram_pairs(names, locations)
        for df in (matched, pairs):
            assert ("hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()) == (rows == 0)
        assert sorted(r["table_name"] for r in matched.where("is_table").collect()) == [f"d.t{i}" for i in range(390, 400)]
        assert {(r["pattern"], r["_name"]) for r in pairs.collect()} >= {(f"zone{i % 7}/tbl_{i}", f"/a/b/Zone{i % 7}/Tbl_{i}") for i in range(390, 400)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
