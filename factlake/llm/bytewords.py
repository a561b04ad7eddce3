"""Words of a text as 64-bit hashes, computed on its UTF-8 bytes with numpy.

A word is a maximal run of ASCII digits, a-z (after lower-casing A-Z) and non-ASCII
characters; every other ASCII character separates words.  Hashes are polynomial in the
word's bytes modulo 2**64 (an odd base is invertible, so one running sum serves all
words), then mixed.  Equal words have equal hashes; callers that need certainty compare bytes.
"""

from __future__ import annotations

import numpy as np

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
PIECE = 1 << 20  # bytes hashed at once: bounds the working arrays for very long texts

_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POW[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def fold(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased (nothing else changes, so offsets stay)."""
    return text.encode("utf-8").lower() if text else b""


def word_spans(arr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = np.zeros(len(arr) + 2, dtype=np.int8)
    m[1:-1] = IS_WORD[arr]
    d = np.diff(m)
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _hash_spans(arr: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(arr)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((arr.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers(BASE_INV, n + 1)[starts])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends) of the words of folded bytes, in order."""
    arr = np.frombuffer(data, dtype=np.uint8)
    starts, ends = word_spans(arr)
    if len(arr) <= PIECE:
        return _hash_spans(arr, starts, ends), starts, ends
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, side="right")))
        lo, hi = int(starts[at]), int(ends[last - 1])
        out[at:last] = _hash_spans(arr[lo:hi], starts[at:last] - lo, ends[at:last] - lo)
        at = last
    return out, starts, ends


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; a shorter text with words has one."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    h = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + words[k:len(words) - size + 1 + k]
    return mix(h)
