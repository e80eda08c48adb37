from pyspark.sql import functions as F

from lakesteward.llm import mixing, quality

SCHEMA = "doc_id long, text string, source string, n_words string"
GOOD = "The cat of the house is in the garden and it was not on the roof of that barn at all today."


def test_odd_rows_are_judged(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (3, GOOD, None, None), (3, GOOD, None, None), (None, "# " * 40 + GOOD, "a", "x"),
            (5, "ab " * 3000, "b", "x"), (6, GOOD.upper(), "b", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {(r.doc_id, r.n_words, r.kept) for r in quality.quality_metrics(docs).collect()}
    assert found == {(1, 0, False), (2, 0, False), (3, 22, True), (None, 62, False), (5, 3000, False), (6, 22, False)}
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [rows[2], rows[3]]
    assert quality.quality_filter(docs.limit(0)).count() == 0


def test_broken_rules_are_named(spark):
    docs = spark.createDataFrame([(1, GOOD.replace(" ", "$ "), "a", None)], SCHEMA)
    assert quality.quality_metrics(docs).first().broken == ["symbols"]


def _targets(sizes, weights=(5, 2, 1)):
    """Repeated sharing of the excess, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, words = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = (words - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            return {**target, **{s: level * weight[s] for s in open_}}
        target.update({s: 2.0 * sizes[s] for s in full})
        open_ -= full
    return target


def test_mix_meets_its_targets(spark):
    rows = [(i, "w " * (i % 37), ("hot", "b", None, "tiny", "é")[0 if i % 3 == 0 else i % 5], None) for i in range(900)]
    rows += [(i % 7, "z " * 40_000 if i == 3 else None, "tiny", None) for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    mix = mixing.mix_sources(docs, block_words=64)
    found = mix.documents.collect()
    assert len(found) == len(rows)
    sizes, taken, target = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    expected = _targets(sizes)
    for source in sizes:
        assert abs(target[source] - expected[source]) < 1e-6 * max(1, expected[source])
        assert abs(taken[source] - target[source]) <= 0.5
    again = mixing.mix_sources(docs.repartition(3), block_words=64).documents
    assert sorted((r.doc_id or 0, r.size, r.taken) for r in again.collect()) == sorted((r.doc_id or 0, r.size, r.taken) for r in found)


def test_schedule_spreads_sources_evenly(spark):
    docs = spark.createDataFrame([(i, "w " * 100, "ab"[i % 2], None) for i in range(400)], SCHEMA)
    slots = mixing.mix_sources(docs, block_words=100).slots.orderBy("position").collect()
    share = sum(s.source == "a" for s in slots) / len(slots)
    for stop in (20, 50, 100, len(slots)):
        assert abs(sum(s.source == "a" for s in slots[:stop]) - share * stop) < 5
    assert all(sorted(s.k for s in slots if s.source == n) == list(range(sum(s.source == n for s in slots))) for n in "ab")


def test_empty_mixes(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(docs).documents.count() == 0
    blank = spark.createDataFrame([(1, None, None, None), (1, " ", "a", None)], SCHEMA)
    assert [(r.size, r.taken, r.target) for r in mixing.mix_sources(blank).documents.collect()] == [(0, 0, 0.0)] * 2
    assert mixing.mixed_documents(blank).count() == 0


def test_mixed_documents_keep_their_columns(spark):
    docs = spark.createDataFrame([(i, "w " * 50, "ab"[i % 2], str(i)) for i in range(40)], SCHEMA).withColumn("_row", F.lit(1))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert max(r["count"] for r in out.groupBy("doc_id").count().collect()) <= 2


def test_output_has_its_sources_in_their_shares_all_along(spark):
    docs = spark.createDataFrame([(i, "w " * 40, "abc"[i % 3] if i % 5 else "c", None) for i in range(900)], SCHEMA)
    rows = [r.source for r in mixing.mixed_documents(docs, block_words=200).collect()]
    whole = {s: rows.count(s) / len(rows) for s in "abc"}
    assert len(rows) > 900 and min(whole.values()) > 0.05
    for stop in range(100, len(rows), 100):
        assert all(abs(rows[:stop].count(s) / stop - whole[s]) < 0.12 for s in "abc")
