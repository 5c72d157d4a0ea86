"""Texts as byte blocks for vectorised work inside Arrow tasks.

A block is a run of whole texts, laid end to end, of a bounded number of bytes (a
single longer text is a block of its own), so what a task holds does not depend on
how many rows Arrow hands over at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)

# Bytes that end a word, by the two word patterns in use.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
ALNUM_GAPS = np.zeros(256, bool)
ALNUM_GAPS[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass
class Block:
    """Rows ``first`` to ``last`` of a batch; row i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    count = len(texts)
    if not count:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + count + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), count)
        cut = offsets[first:last + 1]
        yield Block(first, last, data[cut[0]:cut[-1]], cut - cut[0])
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words of a block; no word crosses a row."""
    inside = ~gaps[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = ~inside[:-1]
    edges = offsets[:-1]
    fresh[edges[edges < len(data)]] = True
    final = np.ones(len(data), bool)
    final[:-1] = ~inside[1:]
    edges = offsets[1:]
    final[edges[edges > 0] - 1] = True
    return np.flatnonzero(inside & fresh), np.flatnonzero(inside & final) + 1


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        room = max(size, BLOCK_BYTES + 1)
        known = np.empty(room, np.uint64)
        known[0] = 1
        done = 1
        while done < room:
            step = min(done, room - done)
            known[done:done + step] = known[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        _POWERS[base] = known
    return known[:size]


def mix(value: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class Prefixes:
    """Hashes of any slices of a byte array, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        back = _powers(_INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all slices of one size."""
        back = _powers(_INVERSE, len(self.sums))[:len(self.sums) - size]
        return mix((self.sums[size:] - self.sums[:-size]) * back)


def sequence_hash(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, by its first word."""
    count = max(len(words) - size + 1, 0)
    total = np.zeros(count, np.uint64)
    for i in range(size):
        total = mix(total + words[i:i + count])
    return total


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Row of each byte position; empty rows own none."""
    return np.searchsorted(offsets, positions, side="right") - 1


def string_list(values: list, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
