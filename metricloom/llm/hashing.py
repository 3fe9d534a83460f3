"""Vectorised byte, word and hash helpers that run inside Spark tasks.

Everything works on the UTF-8 bytes of an Arrow string column, without making
Python strings. A column is walked in chunks of about ``CHUNK`` bytes (a longer
text is a chunk of its own), so memory does not grow with a batch's size.

Hashes are 64-bit: a prefix sum of ``table[byte] * R**position`` (mod 2**64)
gives the hash of any substring in constant time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)

# \x20 and \x09-\x0D separate words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)``, kept and doubled when too short."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1, 2 * (0 if have is None else len(have)))
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.multiply.accumulate(steps)
    return have[:n]


class Substrings:
    """Constant-time hashes of substrings of ``data``."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power("up", _R, len(data)), out=self.sums[1:])
        self.down = _power("down", _R_INV, len(data) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of ``data[start:end]``; the length is part of the hash."""
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64) * U(0xD6E8FEB86659FD93))


@dataclass
class Chunk:
    """Texts ``first .. first + len(offsets) - 1`` of a batch, end to end."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[Chunk]:
    """The texts in runs of about ``limit`` bytes, whole texts each."""
    data, at = text_bytes(texts)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield Chunk(first, data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = IS_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and where each text's words begin in them."""
    word = ~breaks[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = word[heads]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = word[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def pack(values: np.ndarray, dtype: type) -> bytes:
    return np.ascontiguousarray(values, dtype).tobytes()
