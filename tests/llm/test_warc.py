import os
import random

from pyspark.sql import functions as F

from lakesteward.llm import warc
from lakesteward.llm.queries import DAMAGE_EVERY, warc_query
from lakesteward.llm.tables import table
from lakesteward.sources.session import cut, scratch_path

SCHEMA = "page_id long, url string, html string"


def _written(spark, rows):
    path = scratch_path(spark, "warc")
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("file", F.lit("clash"))
    return warc.write_warc(pages, path), path


def test_query_finds_what_it_damaged(spark, sf_dir):
    hurt = F.pmod(F.xxhash64("page_id"), F.lit(DAMAGE_EVERY)) == 0
    expected = {r.page_id for r in table(spark, sf_dir.replace("sf0.001", "sf0.01"), "pages").where(hurt).collect()}
    rows = warc_query(spark, sf_dir.replace("sf0.001", "sf0.01")).collect()
    assert {r.page_id for r in rows if r.status == "corrupt"} == expected and expected
    assert len(rows) == table(spark, sf_dir.replace("sf0.001", "sf0.01"), "pages").count()


def test_records_round_trip(spark):
    rows = [(1, "http://a/é", "<p>é</p>\r\n"), (2, None, None), (2, None, None), (None, "u v\n", ""), (4, "x", "y" * 300_000)]
    catalogue, path = _written(spark, rows)
    found = []
    for r in catalogue.collect():
        with open(f"{path}/files/{r.file}".replace("file:", ""), "rb") as file:
            file.seek(r.first)
            found.append((r.page_id, *warc.read_records(file.read(r.length))))
    assert sorted(found, key=repr) == sorted(((d, (h or "").encode()) for d, _, h in rows), key=repr)


def test_audit_matches_comparing_all(spark):
    rows = [(i, f"u{i}", f"page {i} " * (i % 50)) for i in range(1500)]
    catalogue, path = _written(spark, rows)
    other = scratch_path(spark, "replica")
    rng = random.Random(4)
    bad = sorted(rng.sample(range(1500), 17))
    marked = catalogue.withColumn("bad", F.col("page_id").isin(bad))
    assert warc.copy_replica(marked, path, other, lambda b: b[:-1] + bytes([b[-1] ^ 8]), "bad") == 1500
    names = sorted({r.file for r in catalogue.collect()})
    gone, short = names[0], names[1]
    root = f"{other}/files".replace("file:", "")
    os.truncate(f"{root}/{short}", os.path.getsize(f"{root}/{short}") // 2)
    os.truncate(f"{root}/{gone}", 0)
    ours, theirs = (cut(warc.leaf_hashes(catalogue, p)) for p in (path, other))
    left, right = warc.merkle_levels(ours), warc.merkle_levels(theirs)
    found = {(r.file, r.node): r.status for r in warc.audit(left, right).collect()}
    full = ours.toDF("file", "node", "a").join(theirs.toDF("file", "node", "b"), ["file", "node"]).where("not (a <=> b)").collect()
    assert found == {(r.file, r.node): "missing" if r.b is None else "corrupt" for r in full}
    assert {s for s in found.values()} == {"missing", "corrupt"} and sum(k[0] == gone for k in found) > 0
    assert warc.replica_root(left).first() != warc.replica_root(right).first()
    assert warc.replica_root(left).first() == warc.replica_root(warc.merkle_levels(ours.repartition(3))).first()
    assert warc.audit(left, left).count() == 0


def test_empty_table(spark):
    catalogue, path = _written(spark, [])
    leaves = cut(warc.leaf_hashes(catalogue, path))
    levels = warc.merkle_levels(leaves)
    assert warc.audit(levels, levels).count() == 0


def _leaves(spark, damage=()):
    rows = [(f"f{i:03}", n, n * 10, 10, bytes([i % 256, n, (i, n) in damage])) for i in range(300) for n in range(40)]
    return cut(spark.createDataFrame(rows, "file string, node long, first long, length long, hash binary"))


def test_equal_roots_end_the_audit_at_once(spark):
    left, right = (warc.merkle_levels(_leaves(spark)) for _ in range(2))
    found = warc.audit(left, right)
    assert found.count() == 0 and "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_descent_below_many_files(spark):
    damage = {(3, 7), (3, 39), (250, 0)}
    left, right = warc.merkle_levels(_leaves(spark)), warc.merkle_levels(_leaves(spark, damage))
    assert len(warc.replica_levels(left)) == 3
    assert {(int(r.file[1:]), r.node) for r in warc.audit(left, right).collect()} == damage


def test_offset_ranges_are_part_of_the_tree(spark):
    moved = _leaves(spark).withColumn("first", F.when((F.col("file") == "f005") & (F.col("node") == 3), F.col("first") + 1).otherwise(F.col("first")))
    left, right = warc.merkle_levels(_leaves(spark)), warc.merkle_levels(cut(moved))
    assert warc.replica_root(left).first() != warc.replica_root(right).first()
