import itertools
import random
import re
import string
import unicodedata

from lakesteward.llm import decontaminate as dc
from lakesteward.llm.words import word_hashes
from lakesteward.llm.tables import table
import pyarrow as pa


def test_leaks_match_full_alignment(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = {(r.doc_id, r.item_id): r for r in dc.find_leaks(docs, items).collect()}
    rows, tests = docs.select("doc_id", "text").collect(), items.collect()
    hashes = [word_hashes(pa.array([t.text])).hashes for t in tests]
    expected = {}
    for r in rows:
        words = word_hashes(pa.array([r.text])).hashes
        if len(words):
            best, _, _ = dc.align([words] * len(tests), hashes)
            for t, score, item in zip(tests, best, hashes):
                if score >= dc.MIN_SCORE * dc.MATCH * len(item):
                    expected[r.doc_id, t.item_id] = score / (dc.MATCH * len(item))
    assert {k: round(r.score, 9) for k, r in found.items()} == {k: round(float(v), 9) for k, v in expected.items()}
    assert found


def _rows(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", dc.F.lit("clash"))
    return dc.find_leaks(d, spark.createDataFrame(items, "item_id long, text string"))


def test_edited_copies_and_places(spark):
    rng = random.Random(1)
    item = [f"q{i}" for i in range(40)]
    edited = list(item)
    for k in (6, 17, 30):
        edited[k] = "changed"
    del edited[22]
    filler = [f"f{rng.randrange(10**5)}" for _ in range(3000)]
    docs = [(1, " ".join(filler[:500] + edited + filler[500:])), (2, " ".join(filler)), (3, None), (4, ""), (5, " ".join(item + filler[:9] + item)),
            (5, " ".join(item + filler[:9] + item)), (None, " ".join(item[:19]))]
    items = [(7, " ".join(item)), (8, None), (9, "a b"), (10, ""), (11, " ".join(item))]
    found = sorted((r.doc_id, r.item_id, r.first_word, r.end_word, r.passages) for r in _rows(spark, docs, items).collect())
    assert found == sorted([(1, i, 500, 539, 1) for i in (7, 11)] + [(5, i, 0, 40, 2) for i in (7, 11)] * 2)


def test_frequent_passage_keeps_its_seeds(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = [(i, f"some words before {item} and after {i}") for i in range(200)]
    assert _rows(spark, docs, [(1, item)]).count() == 200


def test_empty_tables(spark):
    assert _rows(spark, [], [(1, "a b c d e f")]).count() == 0
    assert _rows(spark, [(1, "a b c d e f")], []).count() == 0


def test_drop_keeps_columns(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x", "t " + item), (2, "y", "clean text"), (3, None, None)], "doc_id long, item_id string, text string")
    kept = dc.drop_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_blocks_of_items_give_the_same(spark, sf_dir, monkeypatch):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    whole = sorted((r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect())
    monkeypatch.setattr(dc, "BLOCK_WORDS", 500)
    assert len(list(dc.benchmark_blocks(items))) > 2
    assert sorted((r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect()) == whole


def _edges_off(word):
    mark = lambda c: unicodedata.category(c)[0] == "P" or c in string.punctuation
    kept = [i for i, c in enumerate(word) if not mark(c)]
    return (word[kept[0]:kept[-1] + 1] if kept else word)


def _plain_words(text):
    return [_edges_off(w) for w in re.split(r"[\x20\x09-\x0D]+", (text or "").casefold()) if w]


def _plain_score(passage, item):
    before, best = [0] * (len(item) + 1), 0
    for word in passage:
        line = [0]
        for j, other in enumerate(item):
            line.append(max(0, before[j] + (2 if word == other else -1), before[j + 1] - 1, line[j] - 1))
        best, before = max(best, max(line)), line
    return best / (2 * len(item))


def test_case_and_punctuation_do_not_hide_a_copy(spark):
    items = {1: "What is the Straße number of Élodie's house, if she lives at the end?", 2: "Ein „Zitat“ steht hier – don't ask why it’s so — (really).",
             3: "+ - * / + - * /"}
    docs = {1: "Before it. " + items[1].upper() + " And after", 2: items[1].lower().replace(",", ";").replace("?", "!!"),
            3: " ".join(f'"{w}",' for w in items[1].split()), 4: items[2].upper().replace("„", '"').replace("“", '"'),
            5: "what is the number of it , if any ? " * 3, 6: "... " + items[3] + " ...", 7: "*", 8: None, 9: "«" + items[2].swapcase() + "»"}
    found = {(r.doc_id, r.item_id): round(r.score, 9) for r in _rows(spark, list(docs.items()), list(items.items())).collect()}
    scores = {(d, i): _plain_score(_plain_words(t), _plain_words(q)) for d, t in docs.items() for i, q in items.items()}
    assert found == {k: round(v, 9) for k, v in scores.items() if v >= dc.MIN_SCORE}
    assert set(found) == {(1, 1), (2, 1), (3, 1), (4, 2), (6, 3), (9, 2)} and set(found.values()) == {1.0}


def test_folded_hashes_match_folded_words():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAßΣς.,-—“é\U0001F600 \t\n𝒜\U00010100'") for _ in range(rng.randrange(40))) for _ in range(400)] + [None, "", "..", "x"]
    words = word_hashes(pa.array(texts), folded=True)
    plain = [_plain_words(t) for t in texts]
    assert list(words.first[1:] - words.first[:-1]) == [len(w) for w in plain]
    number = {}
    for hashed, word in zip(words.hashes.tolist(), [w for ws in plain for w in ws]):
        assert number.setdefault(word, hashed) == hashed
    assert len(set(number.values())) == len(number)


def test_folded_hashes_of_bytes_that_are_no_text():
    texts = [b"A\x80b. \xe2\x80 \xf0 x\xe2", b"\x80\x94 a\x80B!", b"\xe2"]
    ends = [0, *itertools.accumulate(map(len, texts))]
    offsets = pa.py_buffer(b"".join(n.to_bytes(8, "little") for n in ends))
    words = word_hashes(pa.LargeStringArray.from_buffers(3, offsets, pa.py_buffer(b"".join(texts))), folded=True)
    assert words.first.tolist() == [0, 4, 6, 7] and words.hashes[0] == words.hashes[5]


def test_slices_read_the_same_words_as_single_texts(monkeypatch):
    """Slices of narrow string arrays at any offset, several of them in a batch."""
    from lakesteward.llm import words

    rng = random.Random(7)
    texts = [" ".join(rng.choice(["Ff", "gg.", "Straße", "HH", "é", "Ω"]) for _ in range(rng.randrange(60))) for _ in range(300)] + [None, ""]
    monkeypatch.setattr(words, "SLICE_BYTES", 500)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind)
        parts = list(words.slices(column))
        assert len(parts) > 10
        for low, high in parts:
            found = word_hashes(column.slice(low, high - low), folded=True)
            for i in range(low, high):
                alone = word_hashes(pa.array([texts[i]], kind), folded=True)
                assert (found.hashes[found.first[i - low]:found.first[i - low + 1]] == alone.hashes).all()
                assert len(alone.hashes) == len(_plain_words(texts[i]))


def test_every_copy_in_a_batch_of_many_slices_is_found(spark):
    """Documents of some megabytes in one task; the yardstick normalises by itself."""
    rng = random.Random(9)
    pool = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(pool, k=30))) for i in range(12)]
    docs = []
    for d in range(1500):
        body = rng.choices(pool, k=350)
        if d % 10 == 0:
            at = rng.randrange(300)
            body[at:at] = [w.upper() + "," for w in items[d // 10 % 12][1].split()]
        docs.append((d, " ".join(body)))
    assert sum(len(t) for _, t in docs) > 2 << 20
    found = {(r.doc_id, r.item_id) for r in _rows(spark, docs, items).collect()}
    norm = {i: " ".join(_plain_words(t)) for i, t in items}
    assert found == {(d, i) for d, t in docs for i, n in norm.items() if n in " ".join(_plain_words(t))} and len(found) == 150


def test_short_items_are_compared_whole(spark):
    items = [(1, "Yes, sir!"), (2, "yes"), (3, " "), (4, None), (5, "one two three four five six")]
    docs = [(1, "yes sir"), (2, "YES"), (3, "yes sir and more"), (4, ""), (5, "one two three four five six"), (6, "sir yes")]
    found = {(r.doc_id, r.item_id): (r.score, r.first_word, r.end_word) for r in _rows(spark, docs, items).collect()}
    assert found == {(1, 1): (1.0, 0, 2), (2, 2): (1.0, 0, 1), (5, 5): (1.0, 0, 6)}
    kept = dc.drop_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items[:2], "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
