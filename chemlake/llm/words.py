"""Vectorised word and shingle hashing over Arrow string columns.

Words are hashed by a polynomial over their bytes modulo 2**64 (one random odd value per byte, then a
splitmix64 finaliser); shingles combine neighbouring word hashes.  Everything is computed for a slice of
documents at once, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are hashed at once (about 80 bytes of memory each); one longer document is a slice of its own.
SLICE_BYTES = 1 << 18

_RNG = np.random.default_rng(20240229)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = tuple(_RNG.integers(1, 2**63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_BYTES = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _space_table() -> tuple[np.ndarray, np.ndarray]:
    """Words are runs of anything but space and \\x09-\\x0d; A-Z count as a-z."""
    word = np.ones(256, dtype=bool)
    word[[32, 9, 10, 11, 12, 13]] = False
    values = _BYTES.copy()
    values[65:91] = values[97:123]
    return word, values


def _alnum_table() -> tuple[np.ndarray, np.ndarray]:
    """Words are runs of ASCII letters and digits and of anything outside ASCII; A-Z count as a-z."""
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[65:91] = word[97:123] = word[128:] = True
    values = _BYTES.copy()
    values[65:91] = values[97:123]
    return word, values


SPACE_WORDS, ALNUM_WORDS = _space_table(), _alnum_table()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows that hold about SLICE_BYTES; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    _, offsets_buffer, data = column.buffers()
    offsets = np.frombuffer(offsets_buffer, dtype=np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        end = min(end, n)
        yield at, end, whole[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end
    pa.default_memory_pool().release_unused()  # executors share their memory with the JVM


def word_hashes(data: np.ndarray, offsets: np.ndarray, table=SPACE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, byte at which it starts, index of each document's first word, closed by the total)."""
    word, values = table
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1]
    heads = heads[heads < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(len(offsets), np.int64)
    place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    powers = np.full(int(place.max()) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    terms = values[data[starts[0] :]] * powers[place]
    terms[~inside[starts[0] :]] = 0
    return mix64(np.add.reduceat(terms, starts - starts[0])), starts, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words; run i starts at word i."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : len(words) - size + 1 + i] * _MIX[i % len(_MIX)] ^ np.uint64(i)
    return mix64(total)


def sequence_hash(words: np.ndarray, salt: int) -> np.uint64:
    """Hash of a whole sequence of words, with its length."""
    powers = np.cumprod(np.full(len(words), _MIX[salt % len(_MIX)], dtype=np.uint64), dtype=np.uint64)
    total = np.add.reduce(words * powers, dtype=np.uint64, keepdims=True)
    total += np.array([len(words)], np.uint64) * _MIX[(salt + 1) % len(_MIX)]
    return mix64(total ^ np.uint64(salt))[0]


def shingle_set(words: np.ndarray, runs: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles of one document as bigints; fewer words than `size` are one shingle, none none."""
    if not len(words):
        return np.zeros(0, np.int64)
    if len(words) < size:
        return signed(np.array([sequence_hash(words, 7)], np.uint64))
    return np.unique(signed(runs[: len(words) - size + 1]))


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return np.ascontiguousarray(x).view(np.int64)
