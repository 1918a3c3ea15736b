"""Hashed word shingles and MinHash sketches of whole texts, vectorised over bytes.

Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased. A shingle is the hash
of ``width`` words in order; a text with fewer words has its whole sequence as one shingle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
SKETCH = 64
#: Bytes hashed at a time; a single longer text is hashed alone.
CHUNK = 1 << 21

_rng = np.random.default_rng(20240501)
_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_ODD = _rng.integers(0, 1 << 62, 80, dtype=np.uint64) * _U(2) + _U(1)
_PERM_A = _rng.integers(0, 1 << 62, SKETCH, dtype=np.uint64) * _U(2) + _U(1)
_PERM_B = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by a sort (several times faster here than a hash table)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_BASE), -1, 1 << 64))
    return (np.cumprod(np.full(n, _BASE), dtype=np.uint64), np.cumprod(np.full(n, inverse), dtype=np.uint64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a byte array."""
    if not len(data):
        return np.empty(0, _U), np.empty(0, np.int64)
    word = ~_SPACE[data]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = max(CHUNK, 1 << int(np.ceil(np.log2(len(data) + 1))))
    power, inverse = _powers(size)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUE[_LOWER[data]] * power[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(_U) * _ODD[79]), start


def sets_of(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; empty without words."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    words, start = word_hashes(raw)
    ends = np.cumsum([len(t) + 1 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(start, ends)])
    n = len(words) - width + 1
    if n > 0:
        joined = words[:n] * _ODD[0]
        for i in range(1, width):
            joined = joined + words[i:i + n] * _ODD[i]
        joined = mix(joined)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= width:
            out.append(distinct(joined[lo:hi - width + 1]))
        elif hi > lo:
            k = hi - lo
            out.append(mix((words[lo:hi] * _ODD[10:10 + k]).sum(keepdims=True, dtype=_U) + _ODD[40 + k]))
        else:
            out.append(np.empty(0, _U))
    return out


def sketch_of(values: np.ndarray) -> np.ndarray:
    """MinHash values of a set as 32-bit integers."""
    best = np.full(SKETCH, ~_U(0))
    for at in range(0, len(values), 1024):
        part = values[at:at + 1024, None] * _PERM_A[None] + _PERM_B[None]
        np.minimum(best, part.min(axis=0), out=best)
    return (best >> _U(32)).astype(">u4")


def digest_of(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def text_groups(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of rows of bounded size: (first row, texts as bytes); NULL counts as empty."""
    size = pc.binary_length(column.cast(pa.binary()).fill_null(b"")).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size + 1), 0
    while at < len(column):
        floor = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, floor + limit)))
        yield at, [b"" if t is None else t for t in column.slice(at, end - at).cast(pa.binary()).to_pylist()]
        at = end
