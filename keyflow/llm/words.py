"""Vectorised word hashing.

A word is a maximal run of bytes other than space, tab, LF, VT, FF and CR, that
is ``[^\\x20\\x09-\\x0D]+`` of the text. Hashes are 64-bit and depend only on the
word's bytes.
"""

from __future__ import annotations

import numpy as np

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, so distinct inputs stay distinct)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit values."""
    base = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(base + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)) | _ODD


_weights = stream(1 << 12, 1)


def _weights_for(n: int) -> np.ndarray:
    global _weights
    if n > len(_weights):
        _weights = stream(1 << int(n - 1).bit_length(), 1)
    return _weights


def _piece(arr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~_SPACE[arr]
    flat = np.flatnonzero(solid)
    if not len(flat):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.flatnonzero(np.diff(flat, prepend=-2) != 1)
    lens = np.diff(first, append=len(flat))
    within = np.arange(len(flat)) - np.repeat(first, lens)
    terms = (arr[flat].astype(np.uint64) + _ODD) * _weights_for(int(lens.max()))[within]
    sums = np.add.reduceat(terms, first)
    return mix(sums + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), flat[first]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start offset of each word, in order; memory follows the pieces."""
    arr = np.frombuffer(data, dtype=np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(arr):
        end = min(at + PIECE_BYTES, len(arr))
        while end < len(arr):  # cut at white space
            gap = np.flatnonzero(_SPACE[arr[end : end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + 4096, len(arr))
        h, s = _piece(arr[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def many_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts end to end, and the ``len(texts) + 1`` bounds."""
    data = b"\n".join(texts)
    hashes, starts = word_hashes(data)
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64) if texts else np.empty(0, np.int64)
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)


def gram_hashes(hashes: np.ndarray, k: int, seed: int = 2) -> np.ndarray:
    """Hash of the ``k`` words that start at each position (``len - k + 1`` values)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    w = stream(k, seed)
    out = hashes[:n] * w[0]
    for j in range(1, k):
        out = out + hashes[j : j + n] * w[j]
    return mix(out)
