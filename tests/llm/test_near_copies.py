import math
import random
import re

import numpy as np
import pyarrow as pa

from lakesteward.llm import nearcopies as nc
from lakesteward.llm.groups import components
from lakesteward.llm.tables import table


def _weights(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    counts = {}
    for g in grams:
        counts[g] = counts.get(g, 0) + 1
    return {g: 1 + math.log(n) for g, n in counts.items()}


def _linked(a, b):
    if not a or not b:
        return False
    both = a.keys() & b.keys()
    if not both:
        return False
    if len(both) >= 0.8 * len(a.keys() | b.keys()):
        return True
    p, q = sum(a.values()), sum(b.values())
    total = 0.0
    for i in both:
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return p > 0 and q > 0 and total >= 0.8


def _classes(rows):
    """All pairs of different texts, then union-find; the least id of a class names it."""
    texts = sorted({t or "" for _, t in rows})
    weights = [_weights(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if _linked(weights[i], weights[j]):
                root[find(i)] = find(j)
    place = {t: find(i) for i, t in enumerate(texts)}
    least = {}
    for doc_id, t in rows:
        key = place[t or ""]
        if doc_id is not None:
            least[key] = min(least.get(key, doc_id), doc_id)
    return sorted((d if d is not None else -1, least.get(place[t or ""], -1)) for d, t in rows)


def _found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", nc.F.lit("clash"))
    out = nc.near_copy_classes(docs).collect()
    return sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1) for r in out)


def test_classes_match_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert _found(spark, rows) == _classes(rows)


def test_copies_that_only_meet_through_one_text(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(300), 6):
            words[k] = f"x{i}_{k}"
        rows.append((i, " ".join(words)))
    rows += [(2000 + i, " ".join(f"y{rng.randrange(10**6)}" for _ in range(80))) for i in range(30)]
    assert _found(spark, rows) == _classes(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "one"), (5, "one"), (None, "one"), (None, "lone row of null id here"),
            (7, "a b c"), (8, "a b  c"), (9, "é " * 50_000)]
    assert _found(spark, rows) == _classes(rows)
    assert _found(spark, rows[:0]) == []


def test_one_document_of_a_class_stays(spark):
    text = "a b c d e f g h i j"
    rows = [(2, text, "x"), (1, text, "y"), (1, text, "y"), (3, "other words stand in this text here", "z"), (None, text, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, low string")
    kept = nc.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, text, "y"), (3, rows[3][1], "z")]


def test_registers_agree_with_probability_jaccard():
    left = "".join(f"a{i} " * (1 + i % 3) for i in range(400))
    right = left.replace("a7", "b7").replace("a2", "c2")
    keys, times, _ = nc.shingles(pa.array([left, right]))
    found = nc.signatures(keys, times, 2)
    a, b = _weights(left), _weights(right)
    exact = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())
    assert abs((found[0] == found[1]).mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / nc.REGISTERS)
    half = [keys >> np.uint64(48) == i for i in (0, 1)]
    k = [keys[h] & np.uint64((1 << 48) - 1) for h in half]
    w = [1 + np.log(times[h]) for h in half]
    assert abs(nc._probability_jaccard(k[0], w[0], k[1], w[1]) - exact) < 1e-9


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    links = [x for x in links if x[0] != x[1]]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert sorted((r.u, r.low) for r in found) == sorted((x, find(x)) for x in list(root))


def test_plain_similarity_is_found_where_the_unshared_part_repeats(spark):
    """Shared shingles once, extra ones many times: plain Jaccard above 0.8, that of the weights far below."""
    rng = random.Random(11)
    rows = []
    for i in range(40):
        base = [f"b{i}_{rng.randrange(10**6)}" for _ in range(420)]
        extra = [f"e{i}_{rng.randrange(10**6)}" for _ in range(70)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(base + extra * 30))]
    a, b = _weights(rows[0][1]), _weights(rows[1][1])
    assert len(a.keys() & b.keys()) / len(a.keys() | b.keys()) >= 0.8
    keys, times, _ = nc.shingles(pa.array([rows[0][1], rows[1][1]]))
    found = nc.signatures(keys, times, 2)
    assert (found[0] == found[1]).mean() < 0.75
    assert _found(spark, rows) == _classes(rows) == sorted((d, d - d % 2) for d, _ in rows)
