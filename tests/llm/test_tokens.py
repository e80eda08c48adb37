import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesteward.llm import tokens
from lakesteward.llm.queries import END_ID, TOKENIZER, tokens_of
from lakesteward.llm.tables import table
from lakesteward.sources.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")


def _expected(rows):
    """Straight from the tokenizer, in order of id and text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    start, out = 0, []
    for doc_id, text in sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [END_ID]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: r[1])


def test_ids_match_the_tokenizer(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _sorted(tokens_of(docs).collect()) == _expected(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_BYTES", 4000)
    odd = ["", None, "a<|endoftext|>b <|startoftext|>", "É\u0301\u2028x\u00a0y \x1c z", "don't we'll 'S", "x" * 5000, "ſ K İ ǅ ﬁ", "\u0301 a \u0301",
           "1²3½ ٣", "😀😀 ok", "\n\t "]
    rows = [(i, t) for i, t in enumerate(odd)] + [(None, "null id"), (None, "null id"), (3, "again"), (3, "again"), (3, "twice"), (-5, "low")]
    rng = random.Random(2)
    rows += [(100 + i, " ".join(rng.choice("ab cd' 7é") * rng.randrange(5) for _ in range(60))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h1", F.lit("clash"))
    assert _sorted(tokens_of(docs).collect()) == _expected(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokens_of(docs).collect() == []


def test_unknown_keys_are_not_found(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    keys = spark.range(0, 6000, 2).withColumnRenamed("id", "k")
    found = tokens.lookup(spark, path, keys, "k")
    assert sorted(r.k for r in found.collect()) == list(range(0, 3000, 2))
    read = tokens.read_documents(spark, path, found, "k").where("k = 42").first()
    assert np.frombuffer(read.ids, "<u4")[-1] == END_ID and read.n_tokens == len(read.ids) // 4


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    h1, h2 = (rng.integers(0, 2**63, 20_000, dtype=np.int64).view(np.uint64) for _ in range(2))
    h1[:50] = 7
    levels, slots = tokens.build_mph(h1, h2)
    assert sorted(slots) == list(range(len(h1)))
    assert sum(map(len, levels)) < 6 * len(h1)
    with pytest.raises(ValueError):
        tokens.build_mph(np.array([1, 1], np.uint64), np.array([2, 2], np.uint64))


def test_hot_id_spreads_over_shards(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_BYTES", 2000)
    rows = [(7, f"text {i % 40} of one id")for i in range(900)] + [(None, "same text")] * 300 + [(i, "x") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), END_ID)
    shards = [r.docs for r in spark.read.parquet(f"{path}/manifest").collect()]
    assert len(shards) > 5 and max(shards) < 500
    assert sorted(_sorted(tokens_of(docs).collect()), key=repr) == sorted(_expected(rows), key=repr)


def test_pieces_are_independent_only_if_the_file_says_so(tmp_path):
    import json

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    assert tokens.drops_blanks(whole)
    assert not tokens.drops_blanks(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    parts = json.loads(whole.to_str())
    parts["added_tokens"][0]["lstrip"] = True
    assert not tokens.drops_blanks(Tokenizer.from_str(json.dumps(parts)))


def test_small_memory_gives_the_same_ids(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(TOKENIZER)
    monkeypatch.setattr(tokens, "TABLE_BITS", 4)
    monkeypatch.setattr(tokens, "KEPT_IDS", 60)
    monkeypatch.setattr(tokens, "SLICE_BYTES", 300)
    rng = random.Random(4)
    alphabet = list("ab'' strevlmd \n\t 12\uff12\u00e9!?-.\u3000\u00a0\u0085\x1c\u65e5\u0301\u00bd\u0130") + ["'re", " '", "<|endoftext|>", "\r\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(900))) for _ in range(80)]
    encoder, whole = tokens.Encoder(path, END_ID), Tokenizer.from_file(path)
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids + [END_ID], encoder.type).tobytes() for t in texts]
    assert encoder.encode(texts) == expected
    assert encoder.encode([]) == [] and encoder.encode(["", "\n"]) == [encoder.end] * 2
    # A batch whose last text fills a slice leaves nothing for the last one.
    assert encoder.encode(["a " * 400]) == [np.array(whole.encode("a " * 400, add_special_tokens=False).ids + [END_ID], encoder.type).tobytes()]
