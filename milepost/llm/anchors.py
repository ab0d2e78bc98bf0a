"""Anchors of fixed-length windows and the questions asked about them, shared by
the two substring operators."""

from __future__ import annotations

import numpy as np

from milepost.llm import chunks
from milepost.llm.chunks import Chunk

_PLACE = np.uint64((1 << 20) - 1)
MANY = np.uint64(0xFFFFFFFFFFFFFFFF)  # in place of a run: several of them
SEGMENT = 1 << 19  # windows handled at once, below 2**20


def pair_rank(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Rank of a pair of ranks."""
    x = a * np.uint64(0x9E3779B97F4A7C15 + 2 * salt) + b
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def runs(gram: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of each run.  A window is ``need``
    consecutive prefixes; its anchor is the one with the smallest rank (the first
    of equal ones).  At most 2**20 prefixes."""
    low = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    have = 1
    while have < need:
        n = min(have, need - have)
        low = np.minimum(low[:-n], low[n:])
        have += n
    anchor = (low & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    return first, np.r_[first[1:], len(anchor)] - 1, anchor[first]


def groups(sorted_key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1]]) if len(sorted_key) else np.zeros(0, np.int64)


def low_bytes(x: np.ndarray, n: int = 5) -> np.ndarray:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]


def from_low_bytes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :raw.shape[1]] = raw
    return out.reshape(-1).view("<u8")


LOW39, FLAG = np.uint64((1 << 39) - 1), np.uint64(1 << 39)


def shared_keys(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, whether two ids of the chunk have it, and each row's key number."""
    key, inverse = np.unique(h, return_inverse=True)
    low = np.full(len(key), chunks.NO_ID)
    high = np.full(len(key), np.iinfo(np.int64).min)
    np.minimum.at(low, inverse, ids)
    np.maximum.at(high, inverse, ids)
    return key, low < high, inverse


def least_ids(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the smallest id of each, and each row's key number."""
    key, inverse = np.unique(h, return_inverse=True)
    low = np.full(len(key), chunks.NO_ID)
    np.minimum.at(low, inverse, ids)
    return key, low, inverse


def first_keys(a, chunk: Chunk, run_bytes: int):
    """One entry per anchor rank: key, shared inside the chunk, run (its lowest
    ``run_bytes`` bytes; all ones: several runs)."""
    key, shared, inverse = shared_keys(a.h, chunk.ids[a.doc])
    many = MANY >> np.uint64(64 - 8 * run_bytes)
    run = a.run & many
    run[run == many] = 0
    low = np.full(len(key), many)
    np.minimum.at(low, inverse, run)
    high = np.zeros(len(key), np.uint64)
    np.maximum.at(high, inverse, run)
    return key, shared, low_bytes(np.where(low == high, low, many), run_bytes), inverse


def runs_per_key(inverse: np.ndarray, run: np.ndarray) -> np.ndarray:
    """How many distinct runs each key (by its number) has in a chunk."""
    order = np.lexsort((run, inverse))
    key, run = inverse[order], run[order]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (run[1:] != run[:-1])][:len(key)]
    return np.bincount(key[fresh]).astype(np.uint32)


def shared_anchors(entries: list[bytes], run_bytes: int, hot: int | None = None,
                   hot_runs: int | None = None) -> list[bytes]:
    """Per entry: 0 unique, 1 shared and all runs equal, 2 shared with several runs,
    3 the same in more than ``hot`` chunks or with more than ``hot_runs`` runs, each
    chunk's distinct ones added up (entries then end with their number)."""
    width, many = 5 + run_bytes, MANY >> np.uint64(64 - 8 * run_bytes)
    width += 0 if hot_runs is None else 4
    size = [len(e) // width for e in entries]
    raw = np.frombuffer(b"".join(entries), np.uint8).reshape(-1, width)
    h = from_low_bytes(raw[:, :5])
    run = from_low_bytes(raw[:, 5:5 + run_bytes])
    order = np.argsort(h & LOW39, kind="stable")
    start = groups((h & LOW39)[order])
    n = np.diff(np.r_[start, len(h)])
    shared = (n > 1) | (np.bitwise_or.reduceat(h[order] & FLAG, start) > 0)
    several = np.minimum.reduceat(run[order], start) != np.maximum.reduceat(run[order], start)
    several |= np.maximum.reduceat(run[order], start) == many
    state = np.empty(len(h), np.uint8)
    kind = np.where(shared, 1 + several, 0)
    if hot is not None:
        kind[(kind == 2) & (n > hot)] = 3
    if hot_runs is not None:
        count = np.ascontiguousarray(raw[:, 5 + run_bytes:]).reshape(-1).view("<u4").astype(np.int64)
        kind[(kind == 2) & (np.add.reduceat(count[order], start) > hot_runs)] = 3
    state[order] = np.repeat(kind, n)
    return chunks.split(state, size)


def shared_only(entries: list[bytes]) -> list[bytes]:
    """Per entry of a key and its flag: 1 where two documents have it."""
    size = [len(e) // 5 for e in entries]
    h = from_low_bytes(np.frombuffer(b"".join(entries), np.uint8).reshape(-1, 5))
    order = np.argsort(h & LOW39, kind="stable")
    start = groups((h & LOW39)[order])
    n = np.diff(np.r_[start, len(h)])
    shared = (n > 1) | (np.bitwise_or.reduceat(h[order] & FLAG, start) > 0)
    out = np.empty(len(h), np.uint8)
    out[order] = np.repeat(shared, n)
    return chunks.split(out, size)


def stretches(doc: np.ndarray):
    """(value, start, end) of each run of equal values."""
    at = groups(doc)
    return zip(doc[at].tolist(), at.tolist(), np.r_[at[1:], len(doc)].tolist()) if len(doc) else ()


def send(key: np.ndarray, n_buckets: int, *columns: np.ndarray):
    """(bucket, rows of bytes) of sorted keys; a bucket is the key's top bits."""
    rows = np.concatenate([c if c.ndim == 2 else c.reshape(len(key), 1).view(np.uint8) for c in columns], axis=1)
    for b, part in chunks.cut(bucket_of(key, n_buckets), n_buckets):
        yield b, rows[part].tobytes()


def bucket_of(key: np.ndarray, n_buckets: int) -> np.ndarray:
    return (key >> np.uint64(64 - int(np.log2(n_buckets)))).astype(np.int64)
