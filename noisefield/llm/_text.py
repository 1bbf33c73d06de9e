"""Vectorised text kernels that run inside Spark tasks on Arrow batches."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass handles; a longer document is a pass of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def give_back() -> None:
    """Hands freed memory back to the system: a Python worker lives on between the stages of a job."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    col = batch.column(name)
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def as_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each starts (one more entry than texts); null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    large = texts.cast(pa.large_string()).fill_null("")
    _, starts, data = large.buffers()
    if len(large) == 0 or starts is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(starts, np.int64)[large.offset : large.offset + len(large) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def passes(at: np.ndarray, most: int = CHUNK_BYTES):
    """Ranges of documents whose texts together have at most `most` bytes, or one long document."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        j = min(j, n, i + 60_000)
        yield i, j
        i = j


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the polynomial's base and of its inverse; a worker keeps those for passes of the usual size."""
    if len(_powers[0]) < n:
        made = []
        for base in (_BASE, _BASE_INV):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if n > 2 * CHUNK_BYTES:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, by differences of one running polynomial."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(raw) + 1)
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=run[1:])
    h = (run[end] - run[start]) * down[start]
    return mix(h ^ mix((end - start).astype(np.uint64)))


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of non-space bytes, and each document's first word; no word crosses documents."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(at), np.int64)
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    full = at[1:] > at[:-1]
    a, b = at[:-1][full], at[1:][full] - 1
    first[a] = solid[a]
    last[b] = solid[b]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, at)


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return _LOWER[raw]


def rolling(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes; windows may cross documents, the caller masks those."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        h *= _BASE
        h += words[j : j + len(h)]
    return mix(h)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    return twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys


def sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sum of values between consecutive edges."""
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[edges[1:]] - run[edges[:-1]]
