import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesteward.llm import tokencounts
from lakesteward.llm.lookup import Table, stretch_hashes
from lakesteward.llm.queries import LLM_QUERIES
from lakesteward.llm.tables import table

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def _library(path):
    """Whole texts straight through the library."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        return lambda t: len(model.encode(t))
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    return lambda t: len(whole.encode(t, add_special_tokens=False).ids)


def _expected(rows, path=BYTES, limit=512):
    count = _library(path)
    out = []
    for doc_id, text in rows:
        n = count(text or "")
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=repr)


def _random_texts(seed, n, length):
    rng = random.Random(seed)
    alphabet = list("ab'' strevlmdA \n\t 1٣é!?-.　 \u0085\x1c日😀́½ǅ") + [
        "'re", "'ll", "'s", "'ve", " '", "''", "<|endoftext|>", "<|endof", "\r\n", "   ",
    ]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(length))) for _ in range(n)]


def test_query_counts_as_the_library_does(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    found = LLM_QUERIES["op12_token_counts"](spark, sf_dir)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=repr) == _expected(rows)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed, monkeypatch):
    monkeypatch.setattr(tokencounts, "CACHE_BITS", 5)
    monkeypatch.setattr(tokencounts, "SLICE_CHARS", 200)
    texts = _random_texts(seed, 400, 60) + _random_texts(seed, 20, 3000)
    count = _library(BYTES)
    expected = [count(t) for t in texts]
    counter = tokencounts.Counter(BYTES)
    assert counter.count(texts).tolist() == expected
    # A table with some of the lengths changes nothing, nor does a second look into the cache.
    frequent = Table(8)
    for joined, starts, ends, keys, checks, _ in counter.slices(texts[:50]):
        frequent.put(keys, checks, counter.encoded(joined, starts, ends))
    assert (frequent.values > 0).any()
    assert counter.count(texts, frequent).tolist() == expected


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_encode_whole_texts(spark, name):
    rows = list(enumerate([*_random_texts(9, 30, 80), "", None]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = public_tokenizers.path(name)
    found = tokencounts.token_counts(docs, path, limit=20).collect()
    assert sorted(map(tuple, found), key=repr) == _expected(rows, path, 20)


def test_odd_rows(spark):
    long = "word " * 300_000 + "x" * 50_000
    rows = [(1, None), (1, None), (None, ""), (None, "a b"), (2, long), (3, "<|endoftext|>" * 600), (4, "it's   we'll\n\n 's"), (2, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("n_tokens", F.lit(5))
    found = tokencounts.token_counts(docs, BYTES)
    assert sorted(map(tuple, found.collect()), key=repr) == _expected(rows)
    kept = tokencounts.within_limit(docs, BYTES)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.key, r.n_tokens) for r in kept.collect()) == [
        (False, 0, "clash", 5), (False, 0, "clash", 5), (True, 1, "clash", 5), (True, 1, "clash", 5), (True, 2, "clash", 5), (True, 4, "clash", 5),
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokencounts.token_counts(docs, BYTES).collect() == []


def test_plan_does_not_shuffle(spark, sf_dir):
    plan = tokencounts.token_counts(table(spark, sf_dir, "documents"), BYTES)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_table_holds_what_has_room():
    rng = np.random.default_rng(3)
    keys = rng.integers(1, 2**63, 5000, dtype=np.int64).view(np.uint64)
    checks = rng.integers(0, 2**32, 5000).astype(np.uint32)
    small, large = Table(8), Table(15)
    for t in (small, large):
        t.put(keys, checks, np.arange(1, 5001))
        found = t.get(keys, checks)
        assert ((found == 0) | (found == np.arange(1, 5001))).all()
    assert (large.get(keys, checks) > 0).mean() > 0.95 and (small.get(keys, checks) > 0).sum() <= 256
    assert (large.get(keys, checks + np.uint32(1)) == 0).all()


def test_hashes_tell_stretches_apart():
    data = np.frombuffer(b"ab a ba ab b" + b"a" * 40, np.uint8)
    starts, ends = np.array([0, 3, 5, 8, 11]), np.array([2, 4, 7, 10, 52])
    keys, checks = stretch_hashes(data, starts, ends)
    assert keys[0] == keys[3] and checks[0] == checks[3] and len(set(keys.tolist())) == 4
