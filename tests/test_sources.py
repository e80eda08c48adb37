import json
import uuid

import pytest
from pyspark.sql import functions as F

from lakesteward.operators import catalog
from lakesteward.sources import load, readers, session, sinks


def test_jdbc_options():
    mysql = readers.jdbc_options("mysql", "h", "d", query="select 1", user="u", password="p", query_timeout=5)
    assert mysql["url"].startswith("jdbc:mysql://h:3306/d?connectTimeout=10000") and mysql["query"] == "select 1"
    assert mysql["queryTimeout"] == "5" and mysql["user"] == "u"
    split = readers.jdbc_options("postgres", "h", "d", query="select 1", split=("id", 0, 9, 4), connect_options=["a=b"])
    assert split["url"] == "jdbc:postgresql://h:5432/d?a=b" and split["dbtable"] == "(select 1) AS source_rows"
    assert split["numPartitions"] == "4" and "query" not in split
    for bad in (dict(kind="oracle", query="x"), dict(kind="mysql"), dict(kind="mysql", query="x", table="y")):
        with pytest.raises(ValueError):
            readers.jdbc_options(host="h", database="d", **bad)


def test_text_and_types(spark):
    frame = spark.createDataFrame([(1, None, True)], "a int, b string, c boolean")
    assert tuple(readers.as_text(frame).first()) == ("1", "", "true")
    assert readers.as_text(frame, "<nil>").first()["b"] == "<nil>"
    typed = readers.as_typed(readers.as_text(frame), "c boolean, a bigint, missing string")
    assert tuple(typed.first()) == (True, 1, None) and typed.schema["a"].dataType.simpleString() == "bigint"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.as_typed(spark.createDataFrame([("x",)], "a string"), "a int").collect()


def test_statements(spark):
    name = "t" + uuid.uuid4().hex
    path = session.scratch_path(spark, name)
    readers.exec_statement(spark, f"CREATE TABLE {name} (a INT) USING parquet LOCATION '{path}'")
    try:
        readers.exec_statement(spark, f"INSERT INTO {name} VALUES (1), (2)")
        assert readers.scan_bound(spark, f"SELECT a FROM {name} WHERE a > ?", 1).collect()[0]["a"] == 2
        assert readers.scan_hive(spark, f"SELECT * FROM {name}").count() == 2
    finally:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("source", ["csv", "json", "parquet"])
def test_scan_inventory(spark, source):
    path = session.scratch_path(spark, "listing")
    from lakesteward.sources.schemas import LISTING

    row = ("/a", "1", "2", "3", 9, "DIR", "acl", "u", "g", "STANDARD", "2024-01-01")
    spark.createDataFrame([row], LISTING).write.format(source).save(path)
    assert tuple(readers.scan_inventory(spark, path, source).first()) == row


def test_payloads(spark):
    frame = spark.range(5).select("id", F.lit(None).cast("string").alias("note"), F.lit(7).alias("unused"))
    rows = load.load_payloads(frame, "d", "t", ["note", "id", "absent"], ["id"], 2, "b9").orderBy("label").collect()
    assert [r["label"] for r in rows] == ["d_t_b9_0", "d_t_b9_1", "d_t_b9_2"]
    assert [r["row_count"] for r in rows] == [2, 2, 1]
    assert rows[0]["jsonpaths"] == '["$.note","$.id","$.absent"]'
    assert [list(r) for r in json.loads(rows[0]["body"])] == [["note", "id", "absent"]] * 2
    assert json.loads(rows[2]["body"]) == [{"note": None, "id": 4, "absent": None}]


def test_strict_load(spark):
    frame = spark.createDataFrame([("1", "a"), ("x", "b"), ("3", None), ("y", "skip")], "n string, s string")
    strict = load.strict_load(frame, "n int, s string", where="s is null or s <> 'skip'")
    assert not strict.accepted and tuple(strict.result.first()) == ("Fail", 4, 2, 1, 1)
    assert strict.good.count() == 2 and [tuple(r) for r in strict.rejects.collect()] == [("x", "b")]
    with pytest.raises(ValueError):
        strict.write("/nowhere")
    loose = load.strict_load(frame, "n int, s string", max_filter_ratio=0.5)
    assert loose.accepted and load.is_success(loose.result.first()["status"].upper())
    path = session.scratch_path(spark, "load")
    loose.write(path)
    assert spark.read.parquet(path).count() == 2


def test_sinks(spark):
    path = session.scratch_path(spark, "report")
    frame = spark.createDataFrame([(1, 'a "q", b'), (2, "é")], "n int, s string")
    paths = sinks.report_sink(path, [frame, frame.limit(1)])
    assert [p.rsplit("/", 1)[1] for p in paths] == ["第1页", "第2页"]
    back = spark.read.option("header", True).option("escape", '"').csv(paths[0]).orderBy("n").collect()
    assert [tuple(r) for r in back] == [("1", 'a "q", b'), ("2", "é")]
    assert sinks.sheet_names(1, ["x", "y"]) == ["x"]
    for bad in (lambda: sinks.report_sink(path, []), lambda: sinks.sheet_names(2, ["x"])):
        with pytest.raises(ValueError):
            bad()
    text = sinks.text_sink(frame.select(F.col("s").alias("value")), session.scratch_path(spark, "text"))
    assert {r["value"] for r in spark.read.text(text).collect()} == {'a "q", b', "é"}


CATALOGUE = [("t", 1, "b", "string"), ("t", 0, "aé", "int"), ("one", 0, "x", "bigint")]


@pytest.mark.parametrize("kind", ["create", "select"])
def test_ddl(spark, kind):
    frame = spark.createDataFrame(CATALOGUE, "table_name string, pos int, column_name string, type string")
    made = dict(catalog.ddl_statements(frame, kind, "db").collect())
    if kind == "create":
        assert made["one"] == "create table db.one (\n    " + "`x`".ljust(11) + "    " + "bigint".ljust(16) + "\n)"
        first, second = "`aé`".ljust(13), "`b`".ljust(13)
        assert made["t"] == f"create table db.t (\n    {first}    {'int'.ljust(16)},\n    {second}    {'string'.ljust(16)}\n)"
    else:
        assert made == {"one": "select\n`x`\nfrom db.one", "t": "select\n`aé`,\n`b`\nfrom db.t"}
    lines = {}
    for r in sorted(catalog.ddl_lines(frame, kind, "db").collect(), key=lambda r: (r["section"], r["pos"] or 0)):
        lines.setdefault(r["table_name"], []).append(r["line"])
    assert {t: "\n".join(v) for t, v in lines.items()} == made
    with pytest.raises(ValueError):
        catalog.ddl_statements(frame, "merge")


def test_tags(spark):
    frame = spark.createDataFrame([(1, "x")], "a int, b string")
    frame = frame.withMetadata("a", {"orm": "column:col_a,size:3", "json": "ja"}).withMetadata("b", {"orm": "size:3", "json": "jb"})
    fields = catalog.field_catalogue(frame)
    assert dict(catalog.schema_names(fields, "orm", True, "column:").collect()) == {"col_a": "int"}
    assert dict(catalog.schema_names(fields, "json", False).collect()) == {"a": "ja", "b": "jb"}
    mapping = catalog.tag_mapping(frame, "orm", "json", from_key="column:")
    assert mapping == {"col_a": "ja", "": "jb"}
    renamed = catalog.schema_rename(frame.withColumnRenamed("a", "col_a"), mapping)
    assert renamed.columns == ["ja", "b"]


def test_user_lookup(spark):
    from lakesteward.operators.policies import user_lookup

    users = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], "name string, id int, seq int")
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert dict(user_lookup(names, users, "seq").collect()) == {"a": 2, "b": 3, "c": 0}


def test_hive_settings_do_not_stay(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = readers.scan_hive(spark, "SELECT 1 AS a", {"spark.sql.shuffle.partitions": "3", "lake.own.setting": "x"})
    assert rows.first()["a"] == 1
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and spark.conf.get("lake.own.setting", None) is None


def test_payload_columns_from_the_catalog(spark):
    spark.createDataFrame([], "b string, a int, gone int").createOrReplaceTempView("payload_target")
    rows = spark.createDataFrame([(1, "x", "unused"), (2, "y", "unused")], "a int, b string, c string")
    body = load.load_payloads(rows, "d", "t", "payload_target", ["a"], 10, "1").first()
    assert body["jsonpaths"] == '["$.b","$.a","$.gone"]'
    assert body["body"] == '[{"b":"x","a":1,"gone":null},{"b":"y","a":2,"gone":null}]'
