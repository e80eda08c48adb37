import json
import random

import pytest
from pyspark.sql import functions as F

from lakesteward.operators import policies
from lakesteward.sources import exports
from lakesteward.sources.session import scratch_path

TEXTS = ['plain', 'quote " inside', 'back\\slash', '\\', '\\\\"', '{"not": [a doc]}', '[{', '}]', 'é日😀', '', '\\' * 9, '"' * 5]


def _random_document(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 3)
    if kind == 0:
        return rng.choice(TEXTS)
    if kind == 1:
        return rng.choice([1, -2.5, True, None])
    if kind == 2:
        return rng.choice(TEXTS) * rng.randrange(4)
    if kind == 3:
        return [_random_document(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(TEXTS) + str(i): _random_document(rng, depth + 1) for i in range(rng.randrange(4))}


def _written(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def _read(spark, path, layout, size):
    return [json.loads(r.body) for r in exports.read_documents(spark, path, layout, size).orderBy("file", "place").collect()]


@pytest.mark.parametrize("size", [1, 7, 64, 100_000])
@pytest.mark.parametrize("layout", ["array", "wrapped", "lines"])
def test_ranges_find_every_document_once(spark, tmp_path, monkeypatch, layout, size):
    rng = random.Random(size)
    documents = [{"n": i, "x": _random_document(rng)} for i in range(4 if size == 1 else 60)]
    indent = rng.choice([None, 1]) if layout != "lines" else None
    texts = [json.dumps(d, ensure_ascii=bool(i % 2), indent=indent) for i, d in enumerate(documents)]
    text = {"array": "[ " + " ,\n".join(texts) + "]\n", "wrapped": '{"total": 3, "items": [' + ",".join(texts) + '], "note": "]}"}', "lines": "\n".join(texts)}[layout]
    assert _read(spark, _written(tmp_path, "export.json", text), layout, size) == documents


def test_one_array_is_read_by_several_tasks(spark, tmp_path):
    documents = [{"id": i, "text": "x\\\"{[" * 50} for i in range(500)]
    path = _written(tmp_path, "export.json", json.dumps(documents))
    read = exports.read_documents(spark, path, range_bytes=10_000).withColumn("task", F.spark_partition_id())
    rows = read.collect()
    assert sorted(json.loads(r.body)["id"] for r in rows) == list(range(500)) and len({r.task for r in rows}) > 3


def test_blocks_inside_a_range(monkeypatch, tmp_path):
    """Reading some bytes at a time gives what one read gives, wherever an escape or a quote falls."""
    rng = random.Random(3)
    documents = [{"n": i, "x": _random_document(rng)} for i in range(40)]
    path = _written(tmp_path, "e.json", json.dumps(documents))
    store, name = exports._opened(path)
    for step in (1, 2, 3, 50):
        monkeypatch.setattr(exports, "READ_BYTES", step)
        with store.open_input_file(name) as file:
            assert [json.loads(b) for _, b in exports._documents(file, 0, file.size(), False, 0, 1)] == documents


def test_odd_files(spark, tmp_path):
    _written(tmp_path, "a.json", "[]")
    _written(tmp_path, "b.json", "")
    _written(tmp_path, "c.json", '[1, "two", null, {"id": 3}]')
    _written(tmp_path, "d.json", '[{"id": 4}, {"id": 5, "na')
    found = [r.body for r in exports.read_documents(spark, str(tmp_path), range_bytes=5).orderBy("file", "place").collect()]
    assert found == ['{"id": 3}', '{"id": 4}', '{"id": 5, "na']
    rejects = policies.policy_rejects(exports.read_policies(spark, str(tmp_path)), F.current_timestamp())
    assert rejects.where("body like '%na' and reject_reason = 'unreadable document'").count() == 1


def test_written_exports_come_back(spark):
    rows = spark.range(300).selectExpr("id", "to_json(struct(id, concat('n\"', id % 7) AS name, array(id) AS groupIdList)) AS body")
    for field, layout in ((None, "array"), ("vXUsers", "wrapped")):
        path = scratch_path(spark, "export")
        exports.write_export(rows.repartition(4), path, field)
        for file in spark.read.text(path, wholetext=True).collect():
            json.loads(file.value)
        users = exports.read_users(spark, path, layout, range_bytes=500)
        assert sorted((r.id, r.name, r.groupIdList) for r in users.collect()) == [(i, f'n"{i % 7}', [i]) for i in range(300)]
    path = scratch_path(spark, "export")
    exports.write_export(rows.limit(0), path)
    assert exports.read_documents(spark, path).count() == 0


def test_definitions_keep_their_nested_fields(spark, tmp_path):
    body = {"serviceDefs": [{"id": 1, "name": "hive", "options": {"ui.pages": "x"}, "accessTypes": [{"name": "all", "impliedGrants": ["a", "b"]}],
                             "resources": [{"name": "path", "matcherOptions": {"wildCard": "true"}}]}], "totalCount": 1}
    row = exports.read_definitions(spark, _written(tmp_path, "s.json", json.dumps(body))).first()
    assert row.accessTypes[0].impliedGrants == ["a", "b"] and row.resources[0].matcherOptions.wildCard == "true" and row.options["ui.pages"] == "x"


def test_a_short_range_reads_little_of_a_long_file(tmp_path):
    """What is read follows the range and its last document, not the file or the size of a block."""
    documents = [{"id": i, "text": "x" * 200} for i in range(20_000)]
    path = _written(tmp_path, "e.json", json.dumps(documents))
    store, name = exports._opened(path)

    class Counted:
        read_bytes = 0

        def __init__(self, file):
            self.size, self.seek, self._file = file.size, file.seek, file

        def read(self, n):
            out = self._file.read(n)
            self.read_bytes += len(out)
            return out

    with store.open_input_file(name) as file:
        counted = Counted(file)
        found = [json.loads(b)["id"] for _, b in exports._documents(counted, 0, 10_000, False, 0, 1)]
        assert found == list(range(len(found))) and len(found) > 30
        assert counted.read_bytes < 30_000


def test_short_ranges_share_tasks(spark, tmp_path):
    documents = [{"id": i, "text": "x\\\"{[" * 20} for i in range(3000)]
    path = _written(tmp_path, "export.json", json.dumps(documents))
    read = exports.read_documents(spark, path, range_bytes=1000)
    assert read.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(json.loads(r.body)["id"] for r in read.collect()) == list(range(3000))
