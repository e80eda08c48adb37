import random
from collections import Counter

from pyspark.sql import functions as F

from lakesteward.operators import summaries

LISTING = "name string, atime string, mtime string, ctime string, size_byte long, type string, acl string, user string, `group` string, file_type string, dt string"


def _listing(spark, rows):
    return spark.createDataFrame([(n, "", "", "", s, t, "", u, "", "", "") for n, s, t, u in rows], LISTING)


def test_rollup_adds_up_every_folder(spark):
    rows = [("/a/b/f1", 10, "FILE", "x"), ("/a/b/f2", 5, "FILE", "y"), ("/a/c", 0, "DIR", "x"), ("/", 0, "DIR", "z"), ("/a//deep", 7, "DIR", "x"),
            ("nopath", 9, "FILE", "x"), ("/a/b/f1", 10, "FILE", "x"), ("/1/2/3/4/5/6/7/f", None, "FILE", "w")]
    found = {r.path: (r.path_level, r.objects, r.total_size, r.owners) for r in summaries.path_rollup(_listing(spark, rows)).collect()}
    assert found == {
        "/": (0, 7, 32, 4), "/a": (1, 5, 32, 2), "/a/b": (2, 3, 25, 2), "/a/c": (2, 1, 0, 1), "/1": (1, 1, 0, 1), "/1/2": (2, 1, 0, 1),
        "/1/2/3": (3, 1, 0, 1), "/1/2/3/4": (4, 1, 0, 1), "/1/2/3/4/5": (5, 1, 0, 1),
    }
    assert summaries.path_rollup(_listing(spark, rows).limit(0)).count() == 0


def test_sketch_stays_within_its_error(spark):
    """Owners of overlapping folders: merged sketches, four standard errors at most."""
    rows = spark.range(60_000).selectExpr(
        "concat('/top/d', id % 3, '/f', id) AS name", "'' AS atime", "'' AS mtime", "'' AS ctime", "1L AS size_byte", "'FILE' AS type", "'' AS acl",
        "concat('u', id % 20000) AS user", "'' AS `group`", "'' AS file_type", "'' AS dt",
    )
    for r in summaries.path_rollup(rows).where("path_level <= 2").collect():
        assert abs(r.owners / 20_000 - 1) < 4 * 1.04 / 2 ** (summaries.SKETCH_BITS / 2), r


def test_top_per_group_with_ties(spark):
    rng = random.Random(4)
    rows = [("big" if i % 3 else f"g{i % 5}", f"n{i:04}", rng.randrange(6)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, n string, uses long").repartition(7)
    found = summaries.top_per_group(df, ["g"], [F.col("uses").desc(), F.col("n").asc()], 4, parts=5)
    expected = []
    for group in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == group), key=lambda r: (-r[2], r[1]))[:4]
        expected += [(*r, place + 1) for place, r in enumerate(best)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert summaries.top_per_group(df.limit(0), ["g"], [F.col("n").asc()], 4).count() == 0


def test_top_ranks_parts_before_groups(spark):
    df = spark.range(1000).selectExpr("'one' AS g", "id AS n")
    found = summaries.top_per_group(df, ["g"], [F.col("n").asc()], 2, parts=8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert [(r.n, r["rank"]) for r in found.orderBy("n").collect()] == [(0, 1), (1, 2)]


def test_difference_counts_copies(spark):
    before = [("a", 1), ("a", 1), ("b", 1), ("c", None), ("d", 4), (None, 1), ("e", 1)]
    after = [("a", 1), ("b", 2), ("c", None), ("c", None), ("f", 5), ("f", 5), (None, 1), ("e", 1)]
    a, b = (spark.createDataFrame(x, "name string, size long") for x in (before, after))
    found = {(r.name, r.size): (r.copies, r.status) for r in summaries.snapshot_difference(a, b, "name").collect()}
    assert found == {
        ("a", 1): (-1, "removed"), ("b", 1): (-1, "changed"), ("b", 2): (1, "changed"), ("c", None): (1, "added"), ("d", 4): (-1, "removed"), ("f", 5): (2, "added"),
    }
    counted = Counter(after)
    counted.subtract(Counter(before))
    assert {k: v for k, v in counted.items() if v} == {k: v[0] for k, v in found.items()}
    assert summaries.snapshot_difference(a, a, "name").count() == 0 and summaries.snapshot_difference(a.limit(0), b, "name").count() == 6
