"""Counting quotient filters of n-grams of 64-bit word ids.

An n-gram is a row of ``n`` words of 64 bits. ``permuted`` scrambles it by an
invertible map whose first word is evenly spread; nothing is hashed away. The
leading bits of that first word are the *part* a filter belongs to, the next
ones the *quotient*, the rest of it and the other words the *remainder*, which
is stored in full. A filter holds, for each quotient in turn, how many entries
it has (in unary), then the entries' remainders and counts in order. Counts are
exact and keys come back whole, so filters are lossless; being sorted, they
merge by one pass over both.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

from metricloom.llm.hashing import mix

_U = np.uint64
_HEAD = "<QBBB"
_C1, _C2 = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def unmixed(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = x ^ (x >> _U(33))
    x = x * _U(pow(_C2, -1, 1 << 64))
    x = x ^ (x >> _U(33))
    x = x * _U(pow(_C1, -1, 1 << 64))
    return x ^ (x >> _U(33))


def _of_rest(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    for column in range(1, grams.shape[1]):
        out = mix(out * _U(0x9E3779B97F4A7C15) + grams[:, column] + _U(column))
    return out


def permuted(grams: np.ndarray) -> np.ndarray:
    """The n-grams (rows of ids), each mapped to its place."""
    out = grams.copy()
    out[:, 0] = mix(grams[:, 0] + _of_rest(grams))
    return out


def restored(keys: np.ndarray) -> np.ndarray:
    """The inverse of ``permuted``."""
    out = keys.copy()
    out[:, 0] = unmixed(keys[:, 0]) - _of_rest(keys)
    return out


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, each once, with their counts summed."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys[:, 0], kind="stable")
    keys, counts = keys[order], counts[order]
    same_first = keys[1:, 0] == keys[:-1, 0]
    if keys.shape[1] > 1 and (same_first & (keys[1:] != keys[:-1]).any(1)).any():
        order = np.lexsort(keys.T[::-1])
        keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
    return keys[new], np.add.reduceat(counts, new)


@dataclass
class Counter:
    """Counts of n-grams that grow by batches; ``keys`` are permuted and sorted."""

    n: int
    keys: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls, n: int) -> Counter:
        return cls(n, np.zeros((0, n), np.uint64), np.zeros(0, np.int64))

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = folded(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))

    def __len__(self) -> int:
        return len(self.keys)

    def filters(self, part_bits: int) -> list[tuple[int, bytes]]:
        """(part, filter) of every part that has entries."""
        parts = self.keys[:, 0] >> _U(64 - part_bits)
        first = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(parts))
        return [
            (int(parts[a]), packed(self.keys[a:b], self.counts[a:b], part_bits)) for a, b in zip(first.tolist(), ends.tolist())
        ]


def packed(keys: np.ndarray, counts: np.ndarray, part_bits: int) -> bytes:
    """The filter of sorted, distinct keys that share their leading ``part_bits``."""
    size, n = keys.shape
    quotient_bits = min(max(size.bit_length() - 1, 0), 63 - part_bits)
    rest_bits = 64 - part_bits - quotient_bits
    rest = -(-rest_bits // 8)
    first = keys[:, 0]
    quotient = (first << _U(part_bits)) >> _U(64 - quotient_bits) if quotient_bits else np.zeros(size, np.uint64)
    # In unary: a one for each entry, a zero at the end of each quotient.
    ones = np.arange(size) + quotient.astype(np.int64)
    bits = np.zeros(size + (1 << quotient_bits), bool)
    bits[ones] = True
    low = first & _U((1 << rest_bits) - 1)
    remainder = low.astype("<u8").view(np.uint8).reshape(size, 8)[:, :rest]
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join([
        struct.pack(_HEAD, size, n, part_bits, quotient_bits), np.packbits(bits).tobytes(),
        remainder.tobytes(), keys[:, 1:].astype("<u8").tobytes(),
        small.tobytes(), counts[small == 255].astype("<i8").tobytes(),
    ])


def unpacked(part: int, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a filter, in order."""
    size, n, part_bits, quotient_bits = struct.unpack_from(_HEAD, blob)
    rest_bits = 64 - part_bits - quotient_bits
    rest = -(-rest_bits // 8)
    at = struct.calcsize(_HEAD)

    def take(length: int) -> np.ndarray:
        nonlocal at
        at += length
        return np.frombuffer(blob, np.uint8, length, at - length)

    n_bits = size + (1 << quotient_bits)
    ones = np.flatnonzero(np.unpackbits(take(-(-n_bits // 8)), count=n_bits))
    quotient = (ones - np.arange(size)).astype(np.uint64)
    low = np.zeros((size, 8), np.uint8)
    low[:, :rest] = take(size * rest).reshape(size, rest)
    keys = np.zeros((size, n), np.uint64)
    keys[:, 0] = low.reshape(-1).view("<u8") | (quotient << _U(rest_bits))
    if part_bits:
        keys[:, 0] |= _U(part << (64 - part_bits))
    keys[:, 1:] = take(size * (n - 1) * 8).view("<u8").reshape(size, n - 1)
    counts = take(size).astype(np.int64)
    big = np.flatnonzero(counts == 255)
    counts[big] = take(len(big) * 8).view("<i8")
    return keys, counts
