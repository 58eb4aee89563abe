"""Word shingles of texts as 64-bit hashes, computed over whole Arrow buffers.

Words are the maximal runs without ASCII white space (0x20, 0x09-0x0D), A-Z
lower-cased.  A text's shingles are its runs of ``width`` words; a text with
fewer words has its whole word sequence as its only shingle, one without words
has none.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 whose output bits each depend on all input bits (splitmix64's finisher)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """``n`` fixed odd 64-bit constants."""
    return mix(np.arange(start, start + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


#: A random 64-bit value for each byte, upper-case letters as their lower-case ones, white space 0.
_BYTE = seeds(256, 1000)
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BYTE[_SPACE] = 0
_BASE = int(seeds(1, 7)[0])
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first powers of the word polynomial's base (kept between calls)."""
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 64), _BASE, np.uint64)
        steps[0] = 1
        _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, first word of each text): texts are data[offsets[i]:offsets[i+1]]."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    begins = np.empty(len(data), bool)
    begins[0] = True
    begins[1:] = space[:-1]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins & ~space)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), first
    lengths = np.diff(starts, append=len(data))
    within = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    terms = _BYTE[data[starts[0]:]]
    # beyond its own letters a word's stretch holds only white space, which counts 0
    terms *= _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(terms, starts - starts[0])), first


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in order, first shingle of each text), repeats included."""
    words, first = word_hashes(data, offsets)
    counts = np.diff(first)
    factors = seeds(width, 100)
    short = (counts > 0) & (counts < width)
    sizes = np.where(short, 1, np.maximum(counts - width + 1, 0))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(first[:-1] - begins[:-1], sizes) + np.arange(begins[-1])
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        total += padded[at + k] * factors[k]
    for i in np.flatnonzero(short):
        n = int(counts[i])
        own = words[first[i]:first[i] + n]
        total[begins[i]] = (own * factors[:n]).sum() ^ seeds(width, 200)[n]
    return mix(total), begins


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = shingle_hashes(data, offsets, width)
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
