"""Hashed words and word shingles of whole texts, vectorised over a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
_MULT = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: White space beyond ASCII, as UTF-8 (fixed values): U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WIDE_SPACES = tuple(chr(x).encode() for x in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LEAD = np.zeros(256, bool)
_LEAD[[w[0] for w in WIDE_SPACES]] = True
_KEEP = np.asarray([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: Bytes of a word from which on it is hashed by itself.
LONG_WORD = 256


def _spaces(raw: np.ndarray) -> np.ndarray:
    """Marks of the bytes that belong to white space."""
    out = _SPACE[raw]
    at = np.flatnonzero(_LEAD[raw])
    if len(at):
        tail = np.concatenate([raw, np.zeros(2, np.uint8)])
        for w in WIDE_SPACES:
            hit = at[(tail[at] == w[0]) & (tail[at + 1] == w[1])]
            hit = hit[tail[hit + 2] == w[2]] if len(w) == 3 else hit
            for k in range(len(w)):
                out[hit + k] = True
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all texts; bounds of each text.

    Words are hashed side by side, eight bytes of each at a time.
    """
    plain = pc.utf8_lower(texts.fill_null("")).cast(pa.large_string())
    n = len(plain)
    edge = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + n + 1] if n else np.zeros(1, np.int64)
    size = int(edge[-1] - edge[0])
    if not size:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    raw = np.frombuffer(plain.buffers()[2], np.uint8)[edge[0] : edge[-1]]
    edge = edge - edge[0]
    space = _spaces(raw)
    open_, close = np.empty(size, bool), np.empty(size, bool)
    open_[0] = close[-1] = True
    open_[1:], close[:-1] = space[:-1], space[1:]
    filled = edge[1:] > edge[:-1]
    open_[edge[:-1][filled]] = True
    close[edge[1:][filled] - 1] = True
    start = np.flatnonzero(open_ & ~space)
    length = np.flatnonzero(close & ~space) + 1 - start
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((size,), "<u8", padded.data, strides=(1,))
    with np.errstate(over="ignore"):
        h = mix(length.astype(np.uint64))
        on, k = np.flatnonzero(length < LONG_WORD), 0
        while len(on):
            left = length[on] - k
            h[on] = mix(h[on] ^ (eight[start[on] + k] & _KEEP[np.minimum(left, 8)]) * _MULT[0])
            on, k = on[left > 8], k + 8
    for i in np.flatnonzero(length >= LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(raw[start[i] : start[i] + length[i]].tobytes())
    return h, np.searchsorted(start, edge)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width=WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words; a shorter text is one run of all its words."""
    n = np.diff(bounds)
    total = len(words)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    with np.errstate(over="ignore"):
        sums = np.zeros(total, np.uint64)
        owner = np.repeat(np.arange(len(n)), n)
        left = bounds[1:][owner] - np.arange(total)  # words from here to the text's end
        for j in range(width):
            part = mix(padded[j : j + total] + np.uint64(j)) * _MULT[j]
            sums += np.where(left > j, part, np.uint64(0))
        hashes = mix(sums)
    start = left >= width
    start[bounds[:-1][(n > 0) & (n < width)]] = True
    return hashes[start], np.concatenate([[0], np.cumsum(start)])[bounds]
