"""Vectorised text kernels: rolling hashes, word splitting and winnowed anchors.

All kernels work on one shard at a time: the texts of some thousand documents
laid end to end in a byte array. They need numpy only and run inside tasks.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
POS_BITS = 24                       # a shard holds fewer than 2**24 units
MAX_UNITS = 1 << POS_BITS
WHITE = np.zeros(256, dtype=bool)   # fixed: U+0020 and U+0009..U+000D
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_cache: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _cache.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if n <= 1 << 20:                # longer ones aren't kept
            _cache[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def prefix_sums(units: np.ndarray) -> np.ndarray:
    """Prefix sums of units[i] * BASE**i, so any span's polynomial hash is one difference."""
    sums = np.zeros(len(units) + 1, dtype=np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, len(units)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of units[start:end], the same wherever the span stands."""
    down = _powers("down", _INV, len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def gram_hash(sums: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k units."""
    n = max(len(sums) - k, 0)
    return mix((sums[k:] - sums[:n]) * _powers("down", _INV, n)) if n else np.zeros(0, np.uint64)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, per-document word offsets) of the words of documents data[bounds[i]:bounds[i+1]]."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    ink = ~WHITE[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = ink[inner]
    last[inner - 1] = ink[inner - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, bounds).astype(np.int64)


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values, by doubling."""
    span = 1
    while span * 2 <= w:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[: len(h) - (w - span)], h[w - span:]) if w > span else h


def window_starts(bounds: np.ndarray, window: int) -> np.ndarray:
    """Mask over unit positions: a window of that many units starts here and stays in its document."""
    ok = np.zeros(int(bounds[-1]) + 1, dtype=np.int32)
    full = np.diff(bounds) >= window
    np.add.at(ok, bounds[:-1][full], 1)
    np.add.at(ok, (bounds[1:] - window + 1)[full], -1)
    return np.cumsum(ok[:-1]).astype(bool)


def anchors(units: np.ndarray, bounds: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: the least k-gram hash of every window.

    Returns (position, 40-bit hash, first window start, last window start) of
    each anchor. The windows of an anchor are consecutive, and every window
    that stays in its document belongs to exactly one anchor, chosen by the
    window's content alone (the leftmost of equal hashes).
    """
    none = np.zeros(0, np.int64)
    if len(units) < window:
        return none, none.astype(np.uint64), none, none
    h = gram_hash(prefix_sums(units), k)
    low = np.uint64(MAX_UNITS - 1)
    h &= ~low
    h |= np.arange(len(h), dtype=np.uint64)
    least = sliding_min(h, window - k + 1)
    starts = np.flatnonzero(window_starts(bounds, window)[: len(least)])
    if not len(starts):
        return none, none.astype(np.uint64), none, none
    least = least[starts]
    head = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    tail = np.append(head[1:], len(least)) - 1
    return ((least[head] & low).astype(np.int64), least[head] >> np.uint64(POS_BITS), starts[head], starts[tail])
