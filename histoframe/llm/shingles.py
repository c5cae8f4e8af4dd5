"""Words and word-shingle sets of texts, as 64-bit fingerprints.

A word is a run of bytes other than space and ``\\x09-\\x0D``; A-Z are lower
case first. A document's set holds its distinct shingles of ``width`` words;
with fewer words the whole sequence is the only shingle; without words (or
without a text) the set is empty.

Whole Arrow columns are hashed at once, without a Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a shingle spans unless a caller says otherwise.
WIDTH = 5

#: Bytes hashed in one go; cut at white space, so a longer word goes whole.
_CHUNK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes between words: white space, or everything in ASCII but letters and digits.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """Finalising permutation of 64-bit values, so that order by value is order at random."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _MIX_1
        x ^= x >> np.uint64(27)
        x *= _MIX_2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte, one for both cases of a letter."""
    values = mix(np.arange(1, 257, dtype=np.uint64))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_VALUES = _byte_values()
_powers = np.ones(1, np.uint64)


def _powers_to(n: int) -> np.ndarray:
    """Powers of the odd base, at least ``n`` of them."""
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            steps = np.full(1 << (n - 1).bit_length(), _ODD)
            steps[0] = 1
            _powers = np.multiply.accumulate(steps)
    return _powers


def _hash_words(data: np.ndarray, fresh: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a byte array; a word also starts where ``fresh``."""
    solid = ~separators[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1] | fresh[1:]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return starts, np.empty(0, np.uint64)
    data = data[starts[0] :]
    gaps = np.diff(np.append(starts, starts[0] + len(data)))
    within = np.arange(len(data), dtype=np.int64) - np.repeat(starts - starts[0], gaps)
    with np.errstate(over="ignore"):
        terms = np.where(separators, 0, _VALUES)[data] * _powers_to(int(gaps.max()))[within]
        return starts, mix(np.add.reduceat(terms, starts - starts[0]))


def word_hashes(column: pa.Array, separators: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column in order, and where each row's begin and end (rows + 1 bounds)."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    text = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    starts, hashes, at = [], [], 0
    while at < len(text):
        stop = at + _CHUNK
        while stop < len(text) and not separators[text[stop - 1]]:
            rest = text[stop : stop + _CHUNK]
            stop += int(np.argmax(separators[rest])) + 1 if separators[rest].any() else len(rest)
        stop = min(stop, len(text))
        fresh = np.zeros(stop - at, bool)
        fresh[offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, stop)] - at] = True
        s, h = _hash_words(text[at:stop], fresh, separators)
        starts.append(s + at)
        hashes.append(h)
        at = stop
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def combine(hashes: np.ndarray, span: int) -> np.ndarray:
    """Fingerprint of every run of ``span`` words."""
    n = len(hashes) - span + 1
    total = np.full(n, np.uint64(span))
    factor = _ODD
    with np.errstate(over="ignore"):
        for i in range(span):
            total += hashes[i : i + n] * factor
            factor = factor * _ODD + np.uint64(2 * i + 2)
    return mix(total).view(np.int64)


def shingle_rows(column: pa.Array, width: int = WIDTH, separators: np.ndarray = BLANKS) -> list[np.ndarray]:
    """Each text's shingle fingerprints in order, repeats included."""
    hashes, bounds = word_hashes(column, separators)
    every = combine(hashes, width) if len(hashes) >= width else np.empty(0, np.int64)
    rows = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            rows.append(every[a : b - width + 1])
        else:
            rows.append(combine(hashes[a:b], b - a) if b > a else every[:0])
    return rows


def shingle_sets(column: pa.Array, width: int = WIDTH, separators: np.ndarray = BLANKS) -> list[np.ndarray]:
    """Each text's sorted distinct shingle fingerprints."""
    return [distinct(row) for row in shingle_rows(column, width, separators)]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    out = np.sort(values)
    return out[np.append(True, out[1:] != out[:-1])] if len(out) else out
