"""Vectorised word boundaries and 64-bit word hashes over concatenated texts."""

from __future__ import annotations

import numpy as np
import xxhash

#: Longer words are hashed by XXH64: texts can be built that a polynomial modulo
#: 2**64 maps to one value, but only of many more bytes than this.
LONG = 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_Powers.up) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            setattr(_Powers, name, np.cumprod(p, dtype=np.uint64))
    return _Powers.up[:n], _Powers.down[:n]


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, mask, False].view(np.int8)))
    return edge[::2], edge[1::2]


def span_hashes(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of flat[start:end] (bytes) for each span."""
    up, down = powers(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
    out = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    raw, long = memoryview(flat), np.flatnonzero(end - start > LONG)
    out[long] = np.array([xxhash.xxh64_intdigest(raw[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist())],
                         np.uint64)
    return out


def shingle_hashes(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (ignoring document borders)."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = word[:n].copy()
    for j in range(1, k):
        out *= np.uint64(_BASE)
        out += word[j:j + n]
    return mix(out + np.uint64(k))
