"""Non-decreasing whole numbers in about 2 + log2(bound / n) bits each, with select.

Each number is cut into low bits, which are packed side by side, and a high part, which is written in unary:
number ``i`` sets bit ``(number >> low_bits) + i`` of a bit vector. ``select(i)``, the place of the ``i``-th
set bit, gives the high part back. The place of every ``SAMPLE``-th set bit is kept in 32 bits, so a select
reads a few words from there and no table of 64-bit offsets exists.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = "<QBxxxxxxxQQQ"


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(0, np.uint8)
    spread = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little")


def unpack(packed: np.ndarray, bits: int, start: int, end: int) -> np.ndarray:
    if not bits or end <= start:
        return np.zeros(max(0, end - start), np.uint64)
    first = start * bits
    flat = np.unpackbits(packed[first // 8 : (end * bits + 7) // 8], bitorder="little")
    flat = flat[first % 8 : first % 8 + (end - start) * bits].reshape(-1, bits).astype(np.uint64)
    return (flat << np.arange(bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray, bound: int) -> EliasFano:
        """``values``: non-decreasing, from 0 to ``bound``; may be empty."""
        values, n = np.asarray(values, np.uint64), len(values)
        low_bits = max(0, (bound // n).bit_length() - 1) if n else 0
        places = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        length = (bound >> low_bits) + n + 1
        if length >= 1 << 32:
            raise ValueError("too many numbers for one structure")
        bits = np.zeros(length if n else 0, np.uint8)
        bits[places.astype(np.int64)] = 1
        low = pack(values & np.uint64((1 << low_bits) - 1), low_bits)
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), places[::SAMPLE].astype("<u4"))

    def select(self, i: int) -> int:
        """Place of set bit ``i``: from the sampled bit before it, word by word."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        word = at // 64
        bits = self._word(word) >> (at % 64) << (at % 64)
        while (n := bits.bit_count()) <= left:
            left -= n
            word += 1
            bits = self._word(word)
        for _ in range(left):
            bits &= bits - 1
        return word * 64 + (bits & -bits).bit_length() - 1

    def _word(self, k: int) -> int:
        return int.from_bytes(self.high[8 * k : 8 * k + 8].tobytes(), "little")

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return (self.select(i) - i) << self.low_bits | int(unpack(self.low, self.low_bits, i, i + 1)[0])

    def slice(self, start: int, end: int) -> np.ndarray:
        """Numbers ``start`` to ``end`` (exclusive), unpacked at once."""
        end = min(end, self.n)
        if end <= start:
            return np.zeros(0, np.uint64)
        begin, beyond = start // SAMPLE, -(-end // SAMPLE)
        first = int(self.samples[begin]) // 8
        last = int(self.samples[beyond]) // 8 + 1 if beyond < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:last], bitorder="little")) + 8 * first
        ones = ones[ones >= int(self.samples[begin])]
        ones = ones[start - begin * SAMPLE : end - begin * SAMPLE].astype(np.uint64)
        high = (ones - np.arange(start, end, dtype=np.uint64)) << np.uint64(self.low_bits)
        return high | unpack(self.low, self.low_bits, start, end)

    def search(self, value: int) -> int:
        """Index of the first number that is ``value`` or more."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low

    def to_bytes(self) -> bytes:
        head = struct.pack(HEAD, self.n, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, *sizes = struct.unpack_from(HEAD, data)
        a = struct.calcsize(HEAD)
        b = a + sizes[0]
        c = b + sizes[1]
        return cls(n, low_bits, np.frombuffer(data, np.uint8, sizes[0], a), np.frombuffer(data, np.uint8, sizes[1], b),
                   np.frombuffer(data, "<u4", sizes[2], c))
