"""Word and shingle hashes of many texts at once, with numpy.

Words are runs without ASCII white space, A-Z lower-cased.  A word's hash is a
polynomial over its bytes taken from prefix sums modulo 2**64, so a batch of
texts costs a few array passes, whatever its words are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from gleaner.llm.common import mix64, row_chunks

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _byte_values() -> np.ndarray:
    b = np.arange(256)
    b[65:91] += 32
    return mix64(b.astype(np.uint64) + np.uint64(0x51ED270B))


_VALUES = _byte_values()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done:done + take] = out[:take] * (out[done - 1:done] * base)
        done += take
    return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text)."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    letter = ~_SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = letter.copy()
    start[1:] &= ~letter[:-1] | cut[1:n]
    stop = letter.copy()
    stop[:-1] &= ~letter[1:] | cut[1:n]
    first, last = np.flatnonzero(start), np.flatnonzero(stop) + 1
    powers, inverse = _powers(n, _BASE), _powers(n, _BASE_INV)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers, out=sums[1:])
    hashes = mix64((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    per_text = np.diff(np.searchsorted(first, offsets))
    return hashes, per_text


_MULT = [mix64(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(16)]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words of one text, in order; a shorter
    text is one shingle of all its words; no words give none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(size, n)
    out = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        out += words[i:n - width + 1 + i] * _MULT[i]
    return mix64(out)


def text_words(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, hashes of its words), a chunk of texts at a time."""
    for a, b in row_chunks(offsets):
        hashes, counts = word_hashes(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        ends = np.cumsum(counts)
        for i in range(b - a):
            yield a + i, hashes[ends[i] - counts[i]:ends[i]]


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, its distinct shingles in rising order)."""
    for i, words in text_words(raw, offsets):
        yield i, np.unique(shingle_hashes(words, size))
