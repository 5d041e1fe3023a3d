"""Word shingles of whole Arrow batches at once: hashes of every document's distinct shingles.

Words are runs of bytes other than blanks (0x20, 0x09-0x0D) after lower-casing A-Z. A document's set holds the hashes of
its distinct runs of ``width`` words; a document with fewer words has one, its whole sequence. No words, no set.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_M1, _M2, _M3 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed in one go; temporary arrays take some forty times as much.
PORTION = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(1 << 16)


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in the bytes, and where it starts.

    A word's hash is a polynomial in its bytes, taken from running sums of ``byte * base^position``.
    """
    raw = _LOWER[raw]
    inside = np.concatenate([[False], ~_BLANK[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    # Positions restart in every block of 65,536 bytes, so that the tables of powers stay small; words that cross
    # a block boundary are hashed by themselves.
    position = np.arange(len(raw)) & 0xFFFF
    terms = (raw.astype(np.uint64) + np.uint64(1)) * _UP[position]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    hashes = (sums[ends] - sums[starts]) * _DOWN[starts & 0xFFFF]
    for k in np.flatnonzero((starts >> 16) != ((ends - 1) >> 16)):
        hashes[k] = _long_word(raw[starts[k]:ends[k]])
    return mix(hashes + (ends - starts).astype(np.uint64) * _M3), starts


def _long_word(raw: np.ndarray) -> np.uint64:
    total, scale, step = np.uint64(0), 1, pow(_BASE, 1 << 16, 1 << 64)
    with np.errstate(over="ignore"):
        for first in range(0, len(raw), 1 << 16):
            part = raw[first:first + (1 << 16)].astype(np.uint64) + np.uint64(1)
            total += np.sum(part * _UP[:len(part)], dtype=np.uint64) * np.uint64(scale)
            scale = scale * step % (1 << 64)
    return total


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text; null texts count as empty."""
    out: list[np.ndarray] = []
    texts = texts.cast(pa.large_binary())
    first = 0
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)) if len(texts) else np.empty(0, np.int64)
    while first < len(texts):
        last, held = first + 1, int(sizes[first])
        while last < len(texts) and held + sizes[last] <= PORTION:
            held += int(sizes[last])
            last += 1
        out += _portion([t or b"" for t in texts.slice(first, last - first).to_pylist()], width)
        first = last
    return out


def _portion(texts: list[bytes], width: int) -> list[np.ndarray]:
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    hashes, starts = _word_hashes(raw)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    at = np.searchsorted(starts, bounds)
    if len(hashes) >= width:
        runs = np.zeros(len(hashes) - width + 1, np.uint64)
        for k in range(width):
            runs = mix(runs * _M3 + hashes[k:len(hashes) - width + 1 + k])
    out = []
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for k in range(a, b):
                whole = mix(whole * _M3 + hashes[k:k + 1])
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None
