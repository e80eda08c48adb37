import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesteward.llm import divergence
from lakesteward.llm.queries import LLM_QUERIES
from lakesteward.llm.tables import table

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "text string, lang string, source string"


def _brute(rows, min_docs=10):
    """By the definition, term by term, in Python's whole numbers."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def smooth(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        def price(a, b):
            return (a - b) ** 2 // (a + b)

        q, p = smooth(whole), {s: smooth(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(price(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(price(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 10)):
                found.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def _found(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).withColumn("term", F.lit("clash")).repartition(3)
    return sorted(map(tuple, divergence.source_divergence(docs, **options).collect()))


def _random_rows(seed, n, sources, words):
    rng = random.Random(seed)
    pool = [rng.choice(["Wort", "élan", "日本", "x", "ÀB", "zz"]) + chr(97 + i % 26) * (i // 26 + 1) for i in range(words)]
    rows = []
    for _ in range(n):
        body = rng.choice([" ", "\n", "1", "-", "\x00"]).join(rng.choices(pool, [1 / (i + 1) for i in range(words)], k=rng.randrange(30)))
        rows.append((body, rng.choice(["de", "en", None, ""]), rng.choice([f"s{i}" for i in range(sources)] + [None, ""])))
    return rows


def test_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("text", "lang", "source").collect()]
    found = LLM_QUERIES["op13_divergence"](spark, sf_dir)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == _brute(rows)


@pytest.mark.parametrize("seed, leaves, chunk", [(1, 1024, 48), (2, 4, 2), (3, 1, 1), (4, 7, 3)])
def test_blocks_and_chunks_change_nothing(spark, seed, leaves, chunk):
    rows = _random_rows(seed, 300, 5, 40)
    rows += [rows[0]] * 30 + [(None, "de", "only null"), ("", None, "x"), ("12 34", "numbers", "a"), ("12", "numbers", "b"), ("one of its own", "lone", "a")]
    assert _found(spark, rows, min_docs=4, leaves=leaves, chunk=chunk) == _brute(rows, 4)


def test_ties_are_ranked_by_utf8(spark):
    words = " ".join(["b", "a", "é", "z", "日", "😀", "ａ", *[f"t{c}" for c in "abcdefgh"]])
    rows = [(words, "de", "x")] * 12 + [("filler", "de", "y")] * 12
    assert _found(spark, rows) == _brute(rows)


def test_empty_table(spark):
    assert _found(spark, []) == []


def test_equal_subtrees_are_one_node_and_priced_once():
    counts = np.zeros((3, 1024), np.int64)
    counts[0, :512] = 1
    counts[1, 512:] = 1
    forest = divergence.Forest(counts)
    # All zeros and all ones are one node a level, whichever group and place they come from.
    assert [len(a) for a, _ in forest.children] == [2] * 9 + [3]
    bottoms = np.array([100, 300, 7])
    value, leaf_pairs = forest.priced(np.array([0, 0, 1]), np.array([1, 2, 2]), bottoms)
    assert leaf_pairs == 6
    for k, (g, h) in enumerate([(0, 1), (0, 2), (1, 2)]):
        p, q = (1 + 10**9 * (counts[i] + 2) // bottoms[i] for i in (g, h))
        assert value[k] == ((p - q) ** 2 // (p + q)).sum()


def test_shares_are_exact_for_large_counts():
    counts = [0, 1, 7, 10**9, 10**13, 8 * 10**13]
    for bottom in (3, 10**6 + 1, 10**13 + 7, 9 * 10**13):
        below = [c for c in counts if c < bottom]
        assert divergence.shares(np.array(below, np.int64), bottom).tolist() == [1 + 10**9 * (c + 2) // bottom for c in below]


def test_terms_of_texts():
    texts = ["Ab1cD", "", "é\x00É", "日本 x", "123", "end", "Start"]
    terms, counts = divergence.text_terms([t.encode() for t in texts])
    assert counts.tolist() == [len(TERM.findall(t)) for t in texts]
    assert terms.to_pylist() == [x for t in texts for x in TERM.findall(t.translate(LOWER))]
