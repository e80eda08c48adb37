"""Token counts of whole texts by a map-side lookup in two tiers; no pre-token is shuffled.

A byte-level model encodes each pre-token by itself, so a text's count is the sum over its pre-tokens. These are found for
whole batches at once on arrays of code points. Tier one is a compact hash table of the lengths of frequent pre-tokens, fitted
once and broadcast; what it does not hold goes to a cache of the worker process, and what that does
not hold either is encoded by the library, each different pre-token once, and remembered there. Keys have 96 bits of two hashes.

The table is fitted on about SAMPLE_DOCS documents drawn at random, each task sending TASK_ENTRIES lengths at most. It decides
how fast a count is found, never which: every text is counted whole, whatever the table holds.

How the library's pattern sees a code point (letter, number, blank, other) is asked of the library itself, once for each code
point that occurs. Strings of added tokens count as the library counts them, one each. Tokenizers of another kind
(normalizers, other pre-tokenizers, sentencepiece models) encode whole texts by their own library.

Defined results: a null text is empty and has 0 bytes and 0 tokens; null ids and repeated rows stay rows of their own; an
empty table gives an empty result; other columns are ignored by ``token_counts`` and returned untouched by ``within_limit``. A stretch
of millions of characters without a blank is one piece in one task.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import Table, stretch_hashes
from .tables import free_name, text_or_empty

LIMIT = 512
SAMPLE_DOCS = 1024
TASK_ENTRIES = 4096
TABLE_BITS = 17
CACHE_BITS = 20
# Code points that are handled at once; working arrays take some sixty times as many bytes.
SLICE_CHARS = 1 << 20
LETTER, NUMBER, OTHER, BLANK, UNKNOWN = 0, 1, 2, 3, 255
# Between a plain letter or digit and a blank every such pattern parts, so long texts may be handled in pieces.
CUT = re.compile(r"[A-Za-z0-9](?=[ \n])")
APOSTROPHE, SPACE = ord("'"), ord(" ")
ENDINGS_1 = tuple(map(ord, "stmd"))
ENDINGS_2 = tuple((ord(a), ord(b)) for a, b in ("re", "ve", "ll"))


class Pretokens:
    """Where the pre-tokens of joined texts start, as the byte-level pattern parts them."""

    def __init__(self, split):
        self.split = split
        self.table = np.full(0x110000, UNKNOWN, np.uint8)

    def _kind(self, code: int) -> int:
        for kind, probe in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.split(f"{probe}{chr(code)}{probe}")) == 1:
                return kind
        return BLANK

    def kinds(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if (found == UNKNOWN).any():
            for code in np.unique(codes[found == UNKNOWN]).tolist():
                self.table[code] = self._kind(code)
            found = self.table[codes]
        return found

    def starts(self, codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """``firsts`` are the places where texts begin; none is empty."""
        size = len(codes)
        kinds = self.kinds(codes)
        opens = np.ones(size + 1, bool)
        opens[1:-1] = kinds[1:] != kinds[:-1]
        edge = np.zeros(size + 1, bool)
        edge[firsts] = True
        edge[size] = True
        opens |= edge
        blank = kinds == BLANK
        # Ends of blank runs with something behind them in the same text: a last space goes with it, another last blank is alone.
        last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~edge[1:-1]) if size > 1 else np.zeros(0, np.int64)
        opens[last] = True
        opens[last[codes[last] == SPACE] + 1] = False
        marks = np.flatnonzero((codes == APOSTROPHE) & opens[:-1])
        marks = marks[marks + 1 < size]
        marks = marks[~edge[marks + 1]]
        if len(marks):
            one = codes[marks + 1]
            two = codes[np.minimum(marks + 2, size - 1)]
            whole = (marks + 2 < size) & ~edge[np.minimum(marks + 2, size)]
            short = np.isin(one, ENDINGS_1)
            longer = np.zeros(len(marks), bool)
            for a, b in ENDINGS_2:
                longer |= (one == a) & (two == b) & whole
            opens[marks[short | longer] + 1] = False
            opens[marks[short] + 2] = True
            opens[marks[longer] + 3] = True
        return np.flatnonzero(opens[:-1])


class Counter:
    """Token counts of whole texts, by one tokenizer."""

    def __init__(self, tokenizer_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.pieces = None
        if tokenizer_path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=tokenizer_path)
            self.whole = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        parts = json.loads(tokenizer.to_str())
        pre, added = parts["pre_tokenizer"] or {}, parts["added_tokens"]
        by_pretoken = (
            parts["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and not pre["add_prefix_space"]
            and parts["model"]["type"] == "BPE" and not parts["model"]["dropout"]
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        )
        if by_pretoken:
            self.pieces = Pretokens(tokenizer.pre_tokenizer.pre_tokenize_str)
            names = sorted((t["content"] for t in added), key=len, reverse=True)
            self.added = re.compile("|".join(map(re.escape, names))) if names else None
            self.cache = Table(CACHE_BITS)

    def _parts(self, texts: list[str]) -> tuple[list[str], list[int], np.ndarray]:
        """Stretches to part into pre-tokens, the text of each, and the added tokens of each text."""
        parts, owners, extra = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            pieces = self.added.split(text) if self.added else [text]
            extra[i] = len(pieces) - 1
            for piece in pieces:
                at = 0
                while len(piece) - at > SLICE_CHARS and (stop := CUT.search(piece, at + SLICE_CHARS)):
                    parts.append(piece[at:stop.end()])
                    owners.append(i)
                    at = stop.end()
                if len(piece) > at:
                    parts.append(piece[at:])
                    owners.append(i)
        return parts, owners, extra

    def slices(self, texts: list[str]) -> Iterator[tuple]:
        """``(joined, starts, ends, keys, checks, text of each)`` of the pre-tokens, about SLICE_CHARS code points at a time."""
        parts, owners, _ = self._parts(texts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends, at = np.cumsum(sizes), 0
        while at < len(parts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_CHARS, side="right")))
            joined = "".join(parts[at:stop])
            codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            firsts = np.concatenate(([0], np.cumsum(sizes[at:stop])[:-1]))
            starts = self.pieces.starts(codes, firsts)
            edges = np.append(starts[1:], len(codes))
            keys, checks = stretch_hashes(codes, starts, edges)
            owner = np.asarray(owners[at:stop])[np.searchsorted(firsts, starts, side="right") - 1]
            yield joined, starts, edges, keys, checks, owner
            at = stop

    def encoded(self, joined: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Lengths of pre-tokens by the library."""
        return np.array(self.whole([joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]), np.int64)

    def count(self, texts: list[str], frequent: Table | None = None) -> np.ndarray:
        if self.pieces is None:
            return np.array(self.whole(texts), np.int64)
        total = self._parts(texts)[2] if self.added and any(map(self.added.search, texts)) else np.zeros(len(texts), np.int64)
        for joined, starts, ends, keys, checks, owner in self.slices(texts):
            lengths = frequent.get(keys, checks) if frequent else np.zeros(len(keys), np.int64)
            missed = np.flatnonzero(lengths == 0)
            if len(missed):
                lengths[missed] = self.cache.get(keys[missed], checks[missed])
                missed = missed[lengths[missed] == 0]
            if len(missed):
                both = np.stack([keys[missed], checks[missed].astype(np.uint64)], axis=1)
                _, first, back = np.unique(both, axis=0, return_index=True, return_inverse=True)
                new = missed[first]
                found = self.encoded(joined, starts[new], ends[new])
                self.cache.put(keys[new], checks[new], found)
                lengths[missed] = found[back.reshape(-1)]
            total += np.bincount(owner, lengths, len(texts)).astype(np.int64)
        return total


@functools.lru_cache(maxsize=2)
def _counter(tokenizer_path: str) -> Counter:
    """One counter for all tasks of a worker process."""
    return Counter(tokenizer_path)


def _sampled(batches: Iterator[pa.RecordBatch], tokenizer_path: str) -> Iterator[pa.RecordBatch]:
    """The most frequent pre-tokens of a task's part of the sample."""
    counter, found = _counter(tokenizer_path), []
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for joined, starts, ends, keys, checks, _ in counter.slices(batch.column(0).slice(at, 64).to_pylist()):
                _, first, times = np.unique(keys, return_index=True, return_counts=True)
                best = np.argsort(-times, kind="stable")[:TASK_ENTRIES]
                first, times = first[best], times[best]
                lengths = counter.encoded(joined, starts[first], ends[first])
                found.append(np.stack([keys[first].view(np.int64), checks[first].astype(np.int64), lengths, times], axis=1))
    if found:
        rows = np.concatenate(found)
        _, first, back = np.unique(rows[:, 0], return_index=True, return_inverse=True)
        times = np.bincount(back, rows[:, 3]).astype(np.int64)
        best = np.argsort(-times, kind="stable")[:TASK_ENTRIES]
        rows, times = rows[first[best]], times[best]
        yield pa.RecordBatch.from_arrays([*(pa.array(rows[:, k]) for k in range(3)), pa.array(times)], names=["h", "c", "length", "times"])


def frequent_lengths(docs: DataFrame, tokenizer_path: str) -> Table | None:
    """The broadcast table; None if the tokenizer works on whole texts."""
    if Counter(tokenizer_path).pieces is None:
        return None
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    drawn = docs.select(text_or_empty("text").alias("text")).sample(share, seed=7)
    rows = drawn.mapInArrow(lambda batches: _sampled(batches, tokenizer_path), "h long, c long, length long, times long").toArrow()
    table = Table(TABLE_BITS)
    if rows.num_rows:
        h, c, length, times = (rows.column(k).to_numpy() for k in range(4))
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        best = first[np.argsort(-np.bincount(back, times), kind="stable")[:1 << (TABLE_BITS - 1)]]
        table.put(h[best].view(np.uint64), c[best].astype(np.uint32), length[best])
    return table


def _counted(docs: DataFrame, key: Column, tokenizer_path: str) -> DataFrame:
    """``key, n_bytes, n_tokens`` of each row, in place."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, tokenizer_path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, frequent = _counter(tokenizer_path), sent.value
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [counter.count(texts.slice(at, 1024).to_pylist(), frequent) for at in range(0, len(texts), 1024)]
            tokens = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens)], names=["key", "n_bytes", "n_tokens"])

    narrow = docs.select(key.alias("key"), text_or_empty("text").alias("text"))
    return narrow.mapInArrow(count, f"key {narrow.schema['key'].dataType.simpleString()}, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each document."""
    found = _counted(docs, F.col("doc_id"), tokenizer_path)
    return found.select(F.col("key").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def within_limit(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """The documents of at most ``limit`` tokens; columns unchanged."""
    names = [free_name(docs, n) for n in ("key", "n_bytes", "n_tokens")]
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = _counted(docs, whole, tokenizer_path).toDF(*names).where(F.col(names[2]) <= limit)
    return kept.select(*[F.col(names[0])[c].alias(c) for c in docs.columns])
