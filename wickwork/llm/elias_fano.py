"""Monotone sequences in Elias-Fano form, held in one memory map and searched by whole arrays of queries."""

from __future__ import annotations

import mmap

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
#: Place of the k-th one in a byte, 8 if there is none.
_PLACE = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    for _k, _i in enumerate([i for i in range(8) if _b >> i & 1]):
        _PLACE[_b, _k] = _i


class Map:
    """Arrays side by side in an anonymous memory map."""

    def __init__(self, arrays: list[np.ndarray]) -> None:
        sizes = [-(-a.nbytes // 8) * 8 for a in arrays]
        self.memory, self.arrays, at = mmap.mmap(-1, max(sum(sizes), 8)), [], 0
        for a, size in zip(arrays, sizes, strict=True):
            view = np.frombuffer(self.memory, a.dtype, a.size, at)
            view[:] = a.ravel()
            self.arrays.append(view)
            at += size


class Bits:
    """A bit vector with counts of ones before each word of 64 bits."""

    def __init__(self, held: np.ndarray, before: np.ndarray) -> None:
        self.held, self.before = held, before

    @staticmethod
    def arrays(ones: np.ndarray, length: int) -> list[np.ndarray]:
        flags = np.zeros(-(-(length + 1) // 64) * 64, np.uint8)
        flags[ones] = 1
        held = np.packbits(flags, bitorder="little")
        return [held, np.concatenate([[0], np.cumsum(_ONES[held].reshape(-1, 8).sum(axis=1, dtype=np.int64))])]

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one (or zero), counted from 0."""
        before = self.before if one else 64 * np.arange(len(self.before)) - self.before
        word = np.searchsorted(before, k, "right") - 1
        left, byte, found = k - before[word], word * 8, np.zeros(len(k), bool)
        value = np.zeros(len(k), np.uint8)
        for _ in range(8):
            here = self.held[np.minimum(byte, len(self.held) - 1)]
            here = here if one else ~here
            n = _ONES[here]
            ends = ~found & (left < n)
            value[ends] = here[ends]
            found |= ends
            left, byte = np.where(found, left, left - n), np.where(found, byte, byte + 1)
        return byte * 8 + _PLACE[value, np.clip(left, 0, 7)]


class Sequence:
    """n sorted whole numbers below ``universe``: their low bits packed plainly, their high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, bits: Bits) -> None:
        self.n, self.low_bits, self.low, self.bits = n, low_bits, low, bits

    @staticmethod
    def shape(n: int, universe: int) -> tuple[int, type]:
        low_bits = max(0, int(universe // max(n, 1)).bit_length() - 1)
        return low_bits, np.uint8 if low_bits <= 8 else np.uint16 if low_bits <= 16 else np.uint32 if low_bits <= 32 else np.uint64

    @classmethod
    def arrays(cls, values: np.ndarray, universe: int) -> list[np.ndarray]:
        low_bits, kind = cls.shape(len(values), universe)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        return [(values & np.uint64((1 << low_bits) - 1)).astype(kind), *Bits.arrays(high + np.arange(len(values)), len(values) + int(universe >> low_bits) + 1)]

    @classmethod
    def over(cls, arrays: list[np.ndarray], universe: int) -> Sequence:
        return cls(len(arrays[0]), cls.shape(len(arrays[0]), universe)[0], arrays[0], Bits(*arrays[1:]))

    def access(self, i: np.ndarray) -> np.ndarray:
        high = (self.bits.select(i, True) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self.low[i].astype(np.uint64)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first number >= x (n if there is none): the block of x's high bits, then its low bits."""
        high, low = (x >> np.uint64(self.low_bits)).astype(np.int64), x & np.uint64((1 << self.low_bits) - 1)
        start = np.where(high > 0, self.bits.select(np.maximum(high - 1, 0), False) - high + 1, 0)
        end = self.bits.select(high, False) - high
        while True:
            wide = start < end
            if not wide.any():
                return start
            middle = (start + end) // 2
            less = wide & (self.low[np.minimum(middle, self.n - 1)].astype(np.uint64) < low)
            start, end = np.where(less, middle + 1, start), np.where(wide & ~less, middle, end)
