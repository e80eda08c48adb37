import random
import re

import pytest
from pyspark.sql import functions as F

from lakesteward.llm import linededup as ld
from lakesteward.llm.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _documents(rows):
    return sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, _mark(r[1])))


def _longest_earlier(lines):
    """``{(document, line): lines}``: the most lines from each place on that an earlier place has as well, by sorted suffixes."""
    suffixes = sorted((tuple(body[j:]), i, j) for i, body in enumerate(lines) for j in range(len(body)))
    out = {}
    for at, (mine, i, j) in enumerate(suffixes):
        best = 0
        for step in (-1, 1):
            # The common prefix with what lies further off in sorted order never grows.
            common, k = len(mine), at + step
            while 0 <= k < len(suffixes) and common > best:
                theirs = suffixes[k][0]
                n = 0
                while n < min(common, len(theirs)) and mine[n] == theirs[n]:
                    n += 1
                common = n
                if suffixes[k][1:] < (i, j):
                    best = max(best, common)
                k += step
        out[i, j] = best
    return out


def _brute(rows):
    """The definition in plain Python: from each place the longest run that an earlier place has as well."""
    docs = _documents(rows)
    lines = [[x for x in t.split("\n") if WORD.search(x)] for _, t in docs]
    longest = _longest_earlier(lines)
    out = {}
    for i, body in enumerate(lines):
        gone = set()
        for j in range(len(body)):
            n = longest[i, j]
            if sum(len(WORD.findall(x)) for x in body[j:j + n]) >= ld.MIN_WORDS:
                gone |= set(range(j, j + n))
        kept, at = [], 0
        for x in docs[i][1].split("\n"):
            if WORD.search(x):
                if at not in gone:
                    kept.append(x)
                at += 1
            else:
                kept.append(x)
        out[docs[i]] = (len(body), len(gone), "\n".join(kept))
    return sorted((repr(d), *out[d, t]) if t is not None else (repr(d), 0, 0, "None") for d, t in rows)


def _mark(text):
    import hashlib

    return hashlib.md5(text.encode()).digest()


def _found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit("clash"))
    return sorted((repr(r.doc_id), r.n_lines, r.n_removed, "None" if r.text is None else r.text) for r in ld.dedup_lines(docs).collect())


def test_table_matches_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = _found(spark, rows)
    assert found == _brute(rows) and any(r[2] for r in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_small_alphabet_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ld, "MIN_WORDS", 6)
    rng = random.Random(seed)
    rows = []
    for i in range(25):
        body = [rng.choice(["a b", "c", "d e f", "", "g h i j k l m"]) for _ in range(rng.randrange(0, 14))]
        rows.append((rng.randrange(20), "\n".join(body)))
    rows += [rows[3], rows[3], (None, "a b\nc\nd e f\nc"), (50, None), (51, ""), (52, "\n \n"), (53, "c\n" * 300)]
    assert _found(spark, rows) == _brute(rows)


def test_empty_table(spark):
    assert _found(spark, []) == []


def test_columns_stay(spark):
    run = "\n".join(f"line {i} with some words in it to count" for i in range(9))
    docs = spark.createDataFrame([(1, f"top\n{run}", "x"), (2, f"other\n{run}\nend", "y")], "doc_id long, text string, mark string")
    out = ld.dedup_documents(docs)
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == [(1, f"top\n{run}", "x"), (2, "other\nend", "y")]


def _longest_runs(rows):
    """The definition itself: from each place the most lines that an earlier place has as well."""
    docs = _documents(rows)
    lines = [[x for x in t.split("\n") if WORD.search(x)] for _, t in docs]
    places = [(i, j) for i, body in enumerate(lines) for j in range(len(body))]
    gone = [set() for _ in docs]
    for at, (i, j) in enumerate(places):
        most = 0
        for a, b in places[:at]:
            n = 0
            while j + n < len(lines[i]) and b + n < len(lines[a]) and lines[i][j + n] == lines[a][b + n]:
                n += 1
            most = max(most, n)
        if sum(len(WORD.findall(x)) for x in lines[i][j:j + most]) >= ld.MIN_WORDS:
            gone[i] |= set(range(j, j + most))
    return sorted((repr(d), len(body), len(g)) for (d, _), body, g in zip(docs, lines, gone))


def test_longest_earlier_run_is_found(spark):
    line = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(4)]
    rows = [(1, "\n".join([line[0], line[1], line[3]])), (2, "\n".join(line[:3])), (3, "\n".join(line[:3]))]
    assert [r[:3] for r in _found(spark, rows)] == _longest_runs(rows) == [("1", 3, 0), ("2", 3, 0), ("3", 3, 3)]


@pytest.mark.parametrize("seed", [5, 6])
def test_edited_copies_match_the_definition(spark, seed, monkeypatch):
    monkeypatch.setattr(ld, "MIN_WORDS", 9)
    rng = random.Random(seed)
    first = [f"l{rng.randrange(4)} w" for _ in range(24)]
    rows = []
    for i in range(30):
        body = list(first[rng.randrange(6):24 - rng.randrange(6)])
        for _ in range(rng.randrange(4)):
            body[rng.randrange(len(body))] = f"l{rng.randrange(4)} w"
        rows.append((i, "\n".join(body)))
    assert [r[:3] for r in _found(spark, rows)] == _longest_runs(rows)


def test_many_lines_in_one_text(spark):
    """A text of many lines of which many go takes time in proportion to them."""
    import time

    body = [f"line {i} of a long text" for i in range(60_000)]
    rows = [(1, "\n".join(body)), (2, "\n\n" + "\n".join(body[1000:] + ["one more"]))]
    start = time.time()
    assert [(r[0], r[1], r[2], len(r[3])) for r in _found(spark, rows)] == [("1", 60_000, 0, len(rows[0][1])), ("2", 59_001, 59_000, 10)]
    assert time.time() - start < 300
