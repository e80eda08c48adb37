"""Hashes of stretches of an array and tables from such hashes to numbers, for whole batches at once."""

from __future__ import annotations

import numpy as np

from .words import mix

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))


def stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of 64 bits and a check of 32 more for each ``values[start:end]``; the stretches are in order, not empty, and apart."""
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    low, high = int(starts[0]), int(ends[-1])
    terms = values[low:high].astype(np.uint64) + np.uint64(1)
    following = np.append(starts[1:], high)
    place = np.arange(low, high) - np.repeat(starts, following - starts)
    if (following > ends).any():
        terms[place >= np.repeat(ends - starts, following - starts)] = 0
    longest = int((following - starts).max())
    found = [
        mix(np.add.reduceat(np.cumprod(np.full(longest, base, np.uint64))[place] * terms, starts - low)) for base in _BASES
    ]
    return found[0], (found[1] >> np.uint64(32)).astype(np.uint32)


class Table:
    """Numbers above 0 by key and check, in two possible places a key. Memory is fixed by ``bits``.

    ``put`` never fails: a key takes a place that another one had, and a lookup of that one finds nothing.
    """

    def __init__(self, bits: int):
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.checks = np.zeros(1 << bits, np.uint32)
        self.values = np.zeros(1 << bits, np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - self.bits)
        return (keys >> shift).astype(np.int64), ((keys * np.uint64(0x2545F4914F6CDD1D)) >> shift).astype(np.int64)

    def get(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The numbers, 0 for what is not there."""
        first, second = self._places(keys)
        found = self.values[first]
        missed = np.flatnonzero((self.keys[first] != keys) | (self.checks[first] != checks) | (found == 0))
        if len(missed):
            at = second[missed]
            held = (self.keys[at] == keys[missed]) & (self.checks[at] == checks[missed])
            found[missed] = np.where(held, self.values[at], 0)
        return found

    def put(self, keys: np.ndarray, checks: np.ndarray, values: np.ndarray) -> None:
        """Keys take their first place where it is free and their second otherwise; of several for one place the first wins."""
        first, second = self._places(keys)
        _, chosen = np.unique(first, return_index=True)
        chosen = chosen[self.values[first[chosen]] == 0]
        self._write(first[chosen], keys[chosen], checks[chosen], values[chosen])
        rest = np.ones(len(keys), bool)
        rest[chosen] = False
        rest = np.flatnonzero(rest)
        at, chosen = np.unique(second[rest], return_index=True)
        self._write(at, keys[rest[chosen]], checks[rest[chosen]], values[rest[chosen]])

    def _write(self, at: np.ndarray, keys: np.ndarray, checks: np.ndarray, values: np.ndarray) -> None:
        self.keys[at], self.checks[at], self.values[at] = keys, checks, values

    def clear(self) -> None:
        self.values[:] = 0
