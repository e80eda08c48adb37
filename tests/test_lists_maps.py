import random

import pytest
from pyspark.sql import functions as F

from lakesteward.functions import enums, lists
from lakesteward.functions.maps import map_invert
from lakesteward.functions.text import WHITE_SPACE, trim_ws
from lakesteward.operators import maptables


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def words(*items):
    return F.array(*[F.lit(i) for i in items]) if items else F.array().cast("array<string>")


def test_fixed_cases(spark):
    assert value(spark, lists.list_minus(words("a", "a", "b"), words("b"))) == ["a", "a"]
    assert value(spark, lists.list_intersect(words("c", "a", "a"), words("a", "c", "c"))) == ["a", "c"]
    assert value(spark, lists.list_index(words("a"), F.lit("z"))) == -1
    assert value(spark, lists.list_distinct(words(" a", "a\t"))) == ["a"]
    assert value(spark, lists.list_distinct_lower(words(" A", "a　", "b"))) == ["a", "b"]
    assert value(spark, lists.list_match_any(F.lit("abc"), words(""))) is True
    assert value(spark, lists.list_match_any(F.lit("abc"), [])) is False
    assert value(spark, lists.list_drop_matching(words("abc", "xyz", ""), words("b", "q"))) == ["xyz", ""]
    assert value(spark, lists.list_contains(words("b", "a"), "a")) is True
    assert value(spark, trim_ws(F.lit(WHITE_SPACE + "x y" + WHITE_SPACE))) == "x y"


@pytest.mark.parametrize("count,size,expected", [(5, 2, [2, 2, 1]), (0, 2, []), (4, 2, [2, 2]), (1, 9, [1])])
def test_list_chunks(spark, count, size, expected):
    chunks = value(spark, lists.list_chunks(words(*[str(i) for i in range(count)]), size))
    assert [len(c) for c in chunks] == expected
    assert sum(chunks, []) == [str(i) for i in range(count)]


def test_random_lists(spark):
    rng = random.Random(7)
    rows = [([rng.choice("abcdeéB ") for _ in range(rng.randrange(9))], [rng.choice("abcdeéB ") for _ in range(rng.randrange(5))]) for _ in range(400)]
    frame = spark.createDataFrame(rows, "a array<string>, b array<string>").select(
        "a", "b", lists.list_minus(F.col("a"), F.col("b")).alias("minus"),
        lists.list_intersect(F.col("a"), F.col("b")).alias("both"),
        lists.list_distinct_lower(F.col("a")).alias("lower"),
        lists.list_drop_matching(F.col("a"), F.col("b")).alias("dropped"),
    )
    for r in frame.collect():
        assert r["minus"] == [x for x in r["a"] if x not in r["b"]]
        assert r["both"] == sorted(set(r["a"]) & set(r["b"]))
        assert r["lower"] == list(dict.fromkeys(x.strip().lower() for x in r["a"]))
        assert r["dropped"] == [x for x in r["a"] if not any(p in x for p in r["b"])]


def test_catalogues(spark):
    assert value(spark, enums.name_index(F.lit("create table"), enums.PRIVILEGES)) == 22
    assert value(spark, enums.name_index(F.lit("x"), enums.ACTIONS)) == -1
    assert value(spark, enums.name_index(F.lit(None).cast("string"), enums.ACTIONS)) == -1
    assert value(spark, enums.name_at(F.lit(4), enums.ACTIONS)) == "SELECT"
    assert value(spark, enums.name_at(F.lit(99), enums.ACTIONS)) == "nil"
    assert value(spark, enums.name_at(F.lit(-1), enums.ACTIONS)) == "nil"
    assert value(spark, enums.service_index(F.lit("COS"))) == 2


def test_map_invert(spark):
    rng = random.Random(3)
    maps = [{f"k{i}": rng.choice("xyz") for i in range(rng.randrange(6))} for _ in range(50)]
    frame = spark.createDataFrame([(m,) for m in maps], "m map<string,string>")
    for r in frame.select("m", map_invert(F.col("m")).alias("i")).collect():
        expected = {}
        for k, v in sorted(r["m"].items()):
            expected[v] = k
        assert r["i"] == expected


def test_map_tables(spark):
    schema = "n bigint, m map<string,string>"
    rows = spark.createDataFrame([(1, {"a": "1"}), (2, {"b": "é", "c": "33"}), (3, {"x": "", "y": "4"})], schema)
    assert maptables.map_widest(rows, "m", "n").first()["m"] == {"b": "é", "c": "33"}
    table = maptables.map_to_table(rows, "m", "n")
    assert table.columns == ["n", "b", "c"]
    assert [tuple(r) for r in table.orderBy("n").collect()] == [(1, None, None), (2, "é", "33"), (3, None, None)]
    assert maptables.map_to_table(rows, "m", "n", ["a"]).columns == ["n", "a"]
    assert tuple(maptables.map_max_lengths(rows, "m").first()) == (1, 2)
    empty = rows.where("n > 9")
    assert maptables.map_widest(empty, "m", "n").first()["m"] is None
    assert tuple(maptables.map_max_lengths(empty, "m").first()) == (0, 0)


def test_typed_map_row(spark):
    """The one data row of the original tests: keys of several types."""
    row = spark.createDataFrame([("a", 1, "c", 3, 1.12211)], "a string, b int, c string, d int, e double")
    as_map = row.select(F.lit(1).alias("n"), F.create_map(*[x for c in row.columns for x in (F.lit(c), F.col(c).cast("string"))]).alias("m"))
    assert tuple(maptables.map_to_table(as_map, "m", "n").first()) == (1, "a", "1", "c", "3", "1.12211")
