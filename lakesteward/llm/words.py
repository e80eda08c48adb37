"""Word and word-window hashes of whole batches of texts, computed on their UTF-8 bytes.

Words are the runs of bytes outside 0x20 and 0x09 to 0x0D. No byte of a longer
UTF-8 sequence falls into these ranges, so words never split a character.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are handled in slices of about so many bytes: working arrays take some fifty times as much.
SLICE_BYTES = 1 << 20
SLICE_TEXTS = 1 << 15

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_ASCII_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit integers; a bijection, in place on a copy."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES; a longer text is a range of its own."""
    ends = np.concatenate(([0], np.cumsum(_lengths(texts))))
    start, rows = 0, len(texts)
    while start < rows:
        stop = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, start + 1), rows, start + SLICE_TEXTS)
        yield start, stop
        start = stop


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass
class Words:
    """Word hashes of some texts: those of text i lie at ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _folded(texts: pa.Array) -> pa.Array:
    """The texts with letter case folded as Python's casefold does; bytes that are no UTF-8 stay as they are.

    Folded outside Arrow: its own lower-casing misreads slices whose first offset is not 0.
    """
    rows = texts.cast(pa.large_binary()).to_pylist()
    return pa.array(
        [t.lower() if t.isascii() else t.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape") for t in rows],
        pa.large_binary(),
    )


@cache
def _marks() -> np.ndarray:
    """By code point: Unicode punctuation, and the ASCII signs. Nothing from 0x20000 on is punctuation."""
    table = np.array([unicodedata.category(chr(c))[0] == "P" for c in range(0x20000)])
    table[list(_ASCII_MARKS)] = True
    return table


def _is_mark(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to punctuation."""
    table = _marks()
    marks = np.append(table[:128], np.zeros(128, bool))[data]
    for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        leads = np.flatnonzero((data[:len(data) - size + 1] >= low) & (data[:len(data) - size + 1] < high))
        for k in range(1, size):
            leads = leads[data[leads + k] & 0xC0 == 0x80]
        code = data[leads].astype(np.int64) & ((1 << (7 - size)) - 1)
        for k in range(1, size):
            code = code << 6 | data[leads + k] & 0x3F
        leads = leads[(code < len(table)) & table[np.minimum(code, len(table) - 1)]]
        for k in range(size):
            marks[leads + k] = True
    return marks


def _trimmed(data: np.ndarray, in_word: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word bytes and word starts without punctuation at both ends; a word of punctuation alone stays as it is."""
    core = np.flatnonzero(in_word & ~_is_mark(data))
    if not len(core):
        return in_word, starts
    following = np.append(starts[1:], len(data))
    first = core[np.minimum(np.searchsorted(core, starts), len(core) - 1)]
    last = core[np.searchsorted(core, following) - 1]
    held = (first >= starts) & (first < following)
    begins, ends = np.where(held, first, starts), np.where(held, last + 1, following)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[begins] += 1
    edges[ends] -= 1
    return in_word & (np.cumsum(edges[:-1], dtype=np.int8) > 0), begins


def word_spans(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of joined UTF-8 texts starts and ends; ``firsts`` are the bytes where texts begin."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    fresh = inside[:-1].copy()
    fresh[1:] &= ~inside[:-2]
    firsts = firsts[firsts < len(data)]
    fresh[firsts] = inside[firsts]
    starts = np.flatnonzero(fresh)
    # A word ends where no word byte follows, or where the next text begins.
    ends = inside[:-1] & ~inside[1:]
    ends[firsts[firsts > 0] - 1] = inside[firsts[firsts > 0] - 1]
    return starts, np.flatnonzero(ends) + 1


def word_hashes(texts: pa.Array, folded: bool = False) -> Words:
    """Null texts have no words. ``folded`` words are alike if they differ in letter case and in punctuation around them only."""
    whole = pa.array(texts).cast(pa.large_string()).fill_null("")
    if folded:
        whole = _folded(whole)
    rows = len(whole)
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset:whole.offset + rows + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if rows else (0, 0)
    if high == low:
        return Words(np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64))
    data = np.frombuffer(whole.buffers()[2], dtype=np.uint8)[low:high]
    in_word = _IS_WORD[data]
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    edges = offsets[:-1] - low
    edges = edges[edges < len(data)]
    begins[edges] = in_word[edges]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets - low)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first)
    if folded:
        in_word, starts = _trimmed(data, in_word, starts)
    gaps = np.diff(np.append(starts, len(data)))
    powers = np.cumprod(np.full(int(gaps.max()), _BASE, dtype=np.uint64))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
    values = powers[place] * (data[starts[0]:].astype(np.uint64) + np.uint64(1))
    values[~in_word[starts[0]:]] = 0
    return Words(mix(np.add.reduceat(values, starts - starts[0])), first)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the place of each run's first word."""
    count = len(words.hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(words.first[1:], np.diff(words.first))[:count]
    total = words.hashes[:count].copy()
    for step in range(1, size):
        total *= _BASE
        total += words.hashes[step:step + count]
    places = np.flatnonzero(np.arange(count) + size <= last)
    return mix(total[places]), places
