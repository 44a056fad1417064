"""Hashed 5-word shingle sets of texts, in Arrow batches with numpy. Words are runs of non-blank characters, A-Z lowered.

A word's 64-bit hash is a polynomial over random byte values, read off prefix sums; a shingle's hash mixes its word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SIZE = 5
BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> tuple[np.ndarray, np.ndarray]:
    """A value for each byte, equal for A-Z and a-z; whether the byte belongs to a word."""
    codes = np.arange(256, dtype=np.uint64)
    codes[65:91] += np.uint64(32)
    blank = np.zeros(256, dtype=bool)
    blank[[32, *range(9, 14)]] = True
    return mix(codes * np.uint64(BASE) + np.uint64(1)), ~blank


VALUES, IN_WORD = byte_values()


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends of the rows' bytes) for stretches of rows of about BLOCK bytes; a longer row comes alone."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row + 1 : end + 1] - offsets[row]
        row = end


def made_powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, dtype=np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


block_powers = cache(made_powers)  # of a whole block, made once in a process


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1)."""
    return block_powers(base, BLOCK + 1)[:n] if n <= BLOCK + 1 else made_powers(base, n)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the place of its row."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = IN_WORD[data]
    before = np.diff(inside[:-1]) == 1
    after = np.diff(inside[1:]) == -1
    cuts = ends[:-1][ends[:-1] < len(data)]
    before[cuts] |= inside[1:-1][cuts] == 1
    cuts = cuts[cuts > 0]
    after[cuts - 1] |= inside[1:-1][cuts - 1] == 1
    first, last = np.flatnonzero(before), np.flatnonzero(after) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUES[data] * powers(BASE, len(data)), dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * powers(INVERSE, len(data) + 1)[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(ends, first, side="right")


def distinct(values: np.ndarray) -> np.ndarray:
    """In order, each once."""
    values = np.sort(values)
    first = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=first[1:])
    return values[first]


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its distinct shingle hashes in order), for each row. A text of fewer words is one shingle; without words, none."""
    for row, data, ends in blocks(texts):
        words, owners = word_hashes(data, ends)
        bounds = np.searchsorted(owners, np.arange(len(ends) + 1))
        n = max(len(words) - SIZE + 1, 0)
        runs = np.full(n, SIZE, dtype=np.uint64)
        for k in range(SIZE):
            runs = mix(runs * np.uint64(BASE) + words[k : k + n])
        for i in range(len(ends)):
            start, end = bounds[i], bounds[i + 1]
            if end - start >= SIZE:
                yield row + i, distinct(runs[start : end - SIZE + 1])
            elif end > start:
                one = np.array([end - start], dtype=np.uint64)
                for k in range(start, end):
                    one = mix(one * np.uint64(BASE) + words[k])
                yield row + i, one
            else:
                yield row + i, np.zeros(0, dtype=np.uint64)
