"""Benchmark passages in documents: rare n-gram seeds, then Smith-Waterman alignment of words.

Every run of SEED words of a benchmark item is a possible seed. One pass over all
documents counts how often each occurs; an item keeps the rarest RARE_SHARE of its
own, all that tie with the last one included, so that an item that leaked into a third of the documents keeps its
seeds as well. A second pass finds the seeds in the documents' word windows, gathers the hits of
an item that lie on near diagonals into passages, and aligns each with the item. The score is the
alignment's, divided by the one of a whole, unchanged copy.

Words are compared with letter case folded and without punctuation at their ends, in items and documents alike, so that
shouted, lower-cased and re-punctuated copies share their seeds and align. A word of punctuation alone stays as it is.

The benchmark is the stated query set: its items go out in blocks of bounded size, one after another, and each block meets
all documents in place, without a shuffle of texts. What a block finds is written before the next one goes out.

An item of fewer than SEED words has no seed. It is compared whole: it is found in the documents that have its words and no others.

Defined results: null and empty texts hold no passage and give no seeds; an item without a word is never found; equal items are found alike; repeated documents give repeated rows; empty tables give empty
results; other columns are ignored by ``find_leaks`` and returned untouched by ``drop_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import scratch_path
from .tables import fingerprint, free_name, join_on, text_or_empty
from .words import Words, slices, windows, word_hashes

SEED = 4
RARE_SHARE = 0.75
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
# Words of benchmark text that are sent out at once.
BLOCK_WORDS = 2_000_000
CELLS = 1 << 20
NOTHING = np.uint64(0)


@dataclass
class Block:
    """Some benchmark items: word hashes, and the sorted seeds with the places where each occurs."""

    ids: list
    words: np.ndarray
    first: np.ndarray
    seeds: np.ndarray
    row: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def spots(self, keep: np.ndarray) -> "Block":
        """The same items with some of the seed places only (a place for each seed and item)."""
        owner = np.repeat(np.arange(len(self.seeds)), np.diff(self.row))[keep]
        seeds, counts = np.unique(owner, return_counts=True)
        row = np.concatenate(([0], np.cumsum(counts)))
        return Block(self.ids, self.words, self.first, self.seeds[seeds], row, self.item[keep], self.place[keep])


def read_block(ids: list, texts: list) -> Block:
    words = word_hashes(pa.array(texts, pa.large_string()), folded=True)
    grams, places = windows(words, SEED)
    owner = np.searchsorted(words.first, places, side="right") - 1
    order = np.argsort(grams, kind="stable")
    seeds, counts = np.unique(grams, return_counts=True)
    row = np.concatenate(([0], np.cumsum(counts)))
    return Block(ids, words.hashes, words.first, seeds, row, owner[order], (places - words.first[owner])[order])


def benchmark_blocks(items: DataFrame) -> Iterator[Block]:
    """Items in order of id, read partition by partition, in blocks of BLOCK_WORDS words at most or of one item."""
    ids, texts, size = [], [], 0
    rows = items.select("item_id", text_or_empty("text").alias("text")).sort(F.col("item_id").asc_nulls_first(), "text")
    for item_id, text in rows.toLocalIterator():
        count = text.count(" ") + text.count("\n") + 1
        if ids and size + count > BLOCK_WORDS:
            yield read_block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += count
    if ids:
        yield read_block(ids, texts)


def _matches(block: Block, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows are seeds: their places and the seeds' numbers."""
    if not len(block.seeds):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A table of the hashes' low bits rejects nearly all windows before the search.
    table = np.zeros(1 << 20, bool)
    table[(block.seeds & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
    number = np.minimum(np.searchsorted(block.seeds, grams[maybe]), len(block.seeds) - 1)
    right = block.seeds[number] == grams[maybe]
    return maybe[right], number[right]


def count_seeds(docs: DataFrame, block: Block) -> np.ndarray:
    """How often each seed occurs in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        totals = np.zeros(len(known.seeds), np.int64)
        for batch in batches:
            texts = batch.column(0)
            for low, high in slices(texts):
                grams, _ = windows(word_hashes(texts.slice(low, high - low), folded=True), SEED)
                totals += np.bincount(_matches(known, grams)[1], minlength=len(totals))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"seed": pa.array(seen), "n": pa.array(totals[seen])})

    found = docs.select("text").mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(block.seeds), np.int64)
    for seed, n in found.toLocalIterator():
        counts[seed] = n
    return counts


def rare_seeds(block: Block, counts: np.ndarray) -> Block:
    """The block with the rarest seeds of each item."""
    how_often = np.repeat(counts, np.diff(block.row))
    keep = np.zeros(len(how_often), bool)
    order = np.lexsort((how_often, block.item))
    items, firsts = np.unique(block.item[order], return_index=True)
    for low, high in zip(firsts, np.append(firsts[1:], len(order))):
        own = order[low:high]
        limit = how_often[own[int(np.ceil(RARE_SHARE * len(own))) - 1]]
        keep[own] = how_often[own] <= limit
    return block.spots(keep)


# --- alignment ---------------------------------------------------------------

def align(passages: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair: score, and its last word in the passage and in the item.

    Row by row over the passage, all pairs at once; gaps along the item are a running maximum.
    """
    pairs, high = len(items), max(map(len, passages))
    wide = max(map(len, items))
    rows = np.zeros((high, pairs), np.uint64)
    cols = np.ones((pairs, wide), np.uint64)
    inside = np.zeros((pairs, wide), bool)
    for i, (passage, item) in enumerate(zip(passages, items)):
        rows[:len(passage), i] = passage
        cols[i, :len(item)] = item
        inside[i, :len(item)] = True
    slope = -GAP * np.arange(wide, dtype=np.int32)
    before = np.zeros((pairs, wide + 1), np.int32)
    best = np.zeros(pairs, np.int32)
    end_row, end_col = np.zeros(pairs, np.int64), np.zeros(pairs, np.int64)
    for i in range(high):
        gain = np.where(cols == rows[i][:, None], MATCH, MISMATCH)
        line = np.maximum(np.maximum(before[:, :-1] + gain, before[:, 1:] + GAP), 0).astype(np.int32)
        line = np.where(inside, line, 0)
        line = np.maximum.accumulate(line + slope, axis=1) - slope
        line = np.where(inside, line, 0)
        peak = line.argmax(axis=1)
        top = line[np.arange(pairs), peak]
        better = top > best
        best[better], end_row[better], end_col[better] = top[better], i, peak[better]
        before[:, 1:] = line
    return best, end_row, end_col


def _candidates(block: Block, words, hits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Passages to align, as rows (text, item, first word, last word + 1) with places in the batch's word list."""
    counts = np.diff(block.row)[seeds]
    spots = np.repeat(block.row[seeds] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    place, item, offset = np.repeat(hits, counts), block.item[spots], block.place[spots]
    text = np.searchsorted(words.first, place, side="right") - 1
    begin = place - offset
    order = np.lexsort((begin, item, text))
    text, item, begin = text[order], item[order], begin[order]
    length = np.diff(block.first)[item]
    fresh = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > length[1:] // 2))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(fresh)) - 1
    pad = length[first] // 2 + SEED
    low = np.maximum(begin[first] - pad, words.first[text[first]])
    high = np.minimum(begin[last] + length[first] + pad, words.first[text[first] + 1])
    rows = np.stack([text[first], item[first], low, high], axis=1)
    # Long chains of near diagonals (texts that repeat themselves) are cut into overlapping windows.
    step = 4 * length[first]
    parts = [rows[high - low <= 2 * step]]
    for t, i, a, b in rows[high - low > 2 * step].tolist():
        size = int(block.first[i + 1] - block.first[i])
        parts.append(np.array([(t, i, x, min(x + 6 * size, b)) for x in range(a, b, 4 * size)], np.int64).reshape(-1, 4))
    return np.concatenate(parts)


def _whole(block: Block, words: Words) -> np.ndarray:
    """Rows (text, item, 0, words, 1) of texts that are a short item, word for word."""
    short: dict[bytes, list[int]] = {}
    for item in np.flatnonzero((np.diff(block.first) > 0) & (np.diff(block.first) < SEED)).tolist():
        short.setdefault(block.words[block.first[item]:block.first[item + 1]].tobytes(), []).append(item)
    rows = []
    if short:
        sizes = np.diff(words.first)
        for text in np.flatnonzero((sizes > 0) & (sizes < SEED)).tolist():
            key = words.hashes[words.first[text]:words.first[text + 1]].tobytes()
            rows += [(text, item, 0, int(sizes[text]), 1) for item in short.get(key, ())]
    return np.array(rows, np.int64).reshape(-1, 5)


def scan(block: Block, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Leaks in some texts: integer rows (text, item, first word, last word + 1, passages) and their scores.

    A text and an item have one row, for their best passage.
    """
    words = word_hashes(texts, folded=True)
    whole = _whole(block, words)
    rows, scores = _aligned(block, words)
    return np.concatenate((rows, whole)), np.concatenate((scores, np.ones(len(whole))))


def _aligned(block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The rows of items with seeds."""
    grams, places = windows(words, SEED)
    hits, seeds = _matches(block, grams)
    if not len(hits):
        return np.zeros((0, 5), np.int64), np.zeros(0)
    todo = _candidates(block, words, places[hits], seeds)
    todo = todo[np.argsort((todo[:, 3] - todo[:, 2]) * 4096 + np.diff(block.first)[todo[:, 1]], kind="stable")]
    lengths = np.diff(block.first)
    found, scores, at = [], [], 0
    while at < len(todo):
        stop = at + 1
        while stop < len(todo) and (stop - at + 1) * int(lengths[todo[at:stop + 1, 1]].max()) < CELLS // 64:
            stop += 64
        stop = min(stop, len(todo))
        part = todo[at:stop]
        passages = [words.hashes[a:b] for _, _, a, b in part.tolist()]
        items = [block.words[block.first[i]:block.first[i + 1]] for i in part[:, 1].tolist()]
        best, row, col = align(passages, items)
        good = np.flatnonzero(best >= MIN_SCORE * MATCH * lengths[part[:, 1]])
        if len(good):
            # The same alignment backwards from its end gives its first word.
            back = [passages[i][:row[i] + 1][::-1] for i in good]
            _, length, _ = align(back, [items[i][:col[i] + 1][::-1] for i in good])
            end = part[good, 2] + row[good] + 1
            start = words.first[part[good, 0]]
            found.append(np.stack([part[good, 0], part[good, 1], end - 1 - length - start, end - start], axis=1))
            scores.append(best[good] / (MATCH * lengths[part[good, 1]]))
        at = stop
    if not found:
        return np.zeros((0, 5), np.int64), np.zeros(0)
    rows, score = np.concatenate(found), np.concatenate(scores)
    order = np.lexsort((rows[:, 2], -score, rows[:, 1], rows[:, 0]))
    rows, score = rows[order], score[order]
    new = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
    groups = np.cumsum(new) - 1
    passages = np.array([len(np.unique(rows[groups == g, 2])) for g in range(groups[-1] + 1)])
    return np.column_stack((rows[new], passages)), score[new]


def _found(docs: DataFrame, sent, schema: str) -> DataFrame:
    """The leaks of one block."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        ids = pa.array(block.ids)
        for batch in batches:
            for low, high in slices(batch.column(1)):
                rows, score = scan(block, batch.column(1).slice(low, high - low))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(low, high - low).take(pa.array(rows[:, 0])), ids.take(pa.array(rows[:, 1])),
                         pa.array(score), *[pa.array(rows[:, k]) for k in (2, 3, 4)]],
                        names=["doc_id", "item_id", "score", "first_word", "end_word", "passages"],
                    )

    return docs.select("doc_id", "text").mapInArrow(find, schema)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, first_word, end_word, passages`` of each document and item with a passage."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType.simpleString()
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {id_type}, "
        "score double, first_word long, end_word long, passages long"
    )
    paths = []
    for block in benchmark_blocks(items):
        sent = spark.sparkContext.broadcast(rare_seeds(block, count_seeds(docs, block)))
        paths.append(scratch_path(spark, "leaks"))
        _found(docs, sent, schema).write.parquet(paths[-1])
        sent.destroy()
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a passage of any item; columns unchanged.

    Documents with one text share their fate, so leaks are looked up by text.
    """
    leaks = find_leaks(docs.select(fingerprint("text").alias("doc_id"), "text"), items)
    mark = free_name(docs, "_mark")
    leaked = leaks.select(F.col("doc_id").alias(mark)).distinct()
    kept = join_on(docs.withColumn(mark, fingerprint("text")), leaked, [mark], "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
