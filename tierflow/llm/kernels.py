"""Array kernels on bytes that the operators run inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
#: Odd multipliers and a table of byte values with well spread bits.
_BASE = 0x9E3779B97F4A7C55
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}
#: glibc keeps freed memory that lies between live objects; other libraries have no such call.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def settle() -> None:
    """Hand freed memory back to the system: a worker outlives its task and would hold it
    through later stages, beside their workers and the executor."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base]) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        _POWERS[base] = np.cumprod(p, dtype=np.uint64)
    return _POWERS[base][:n]


def slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive entries of at most ``most`` in sum; a larger entry is alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, and the number of words of each text."""
    body = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(body, np.uint8)
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    n = len(buf) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum(_TABLE[buf] * powers(_BASE, n)[1:], dtype=np.uint64, out=sums[1:])
    inverse = powers(pow(_BASE, -1, 1 << 64), n)
    hashed = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashed + (ends - starts).astype(np.uint64)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text; a shorter text is one run."""
    ends = np.cumsum(counts)
    out = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    left = np.repeat(ends, counts) - np.arange(len(words))  # words from here to the text's end
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(left > k, padded[k : k + len(words)], np.uint64(0))
    first = np.zeros(len(words), bool)
    first[(ends - counts)[counts > 0]] = True
    keep = (left >= size) | first
    return mix(out[keep]), np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)


class Lookup:
    """Values by 64-bit keys in an open-addressing table; absent keys have ``default``."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.mask = (1 << self.bits) - 1
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, default, values.dtype)
        self.full = np.zeros(1 << self.bits, bool)
        self.default = default
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = ~self.full[slot]
            _, winner = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[winner]
            self.keys[slot[won]], self.values[slot[won]] = keys[left[won]], values[left[won]]
            self.full[slot[won]] = True
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and which of the keys are in the table."""
        slot = self._slot(keys)
        hit = self.full[slot] & (self.keys[slot] == keys)
        out = np.where(hit, self.values[slot], self.default).astype(self.values.dtype)
        left = np.flatnonzero(~hit & self.full[slot])
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            same = self.full[slot] & (self.keys[slot] == keys[left])
            out[left[same]] = self.values[slot[same]]
            hit[left[same]] = True
            go = self.full[slot] & ~same
            left, slot = left[go], slot[go]
        return out, hit
