"""Elias-Fano code of a rising sequence, with select.

Of each value the low bits stand as they are and the high bits as the gaps of a
unary code, which takes about 2 + log2(universe / n) bits a value. Every 256th
one of the unary code has its place noted, so select reads a bounded stretch.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQB")


def encode(values: np.ndarray) -> bytes:
    """Bytes of a sequence of non-negative integers, each at least the one before."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0)
    if n > 1 and bool((values[1:] < values[:-1]).any()):
        raise ValueError("values must not fall")
    universe = int(values[-1])
    low = max(0, (universe // n).bit_length() - 1) if universe else 0
    lows = (values & np.uint64((1 << low) - 1))[:, None] >> np.arange(low, dtype=np.uint64)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(ones[-1]) + 1, np.uint8)
    upper[ones] = 1
    return b"".join(
        (
            _HEAD.pack(n, len(upper), low),
            ones[::SAMPLE].astype("<u8").tobytes(),
            np.packbits((lows & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(upper, bitorder="little").tobytes(),
        )
    )


class EliasFano:
    """Reads a sequence from its bytes without unpacking all of it."""

    def __init__(self, data: bytes | memoryview) -> None:
        self.n, upper_bits, self.low = _HEAD.unpack_from(data)
        at = _HEAD.size
        samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u8", samples, at)
        at += 8 * samples
        low_bytes = -(-self.n * self.low // 8)
        self.lows = np.frombuffer(data, np.uint8, low_bytes, at)
        at += low_bytes
        self.upper = np.frombuffer(data, np.uint8, -(-upper_bits // 8), at)
        self.size = at + len(self.upper)

    def __len__(self) -> int:
        return self.n

    def _low(self, begin: int, count: int) -> np.ndarray:
        if not self.low:
            return np.zeros(count, np.uint64)
        first, last = begin * self.low, (begin + count) * self.low
        bits = np.unpackbits(self.lows[first // 8 : -(-last // 8)], bitorder="little")
        bits = bits[first % 8 : first % 8 + count * self.low].reshape(count, self.low)
        return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.low, dtype=np.uint64))

    def select(self, i: int) -> int:
        """The value at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        left, block = i % SAMPLE, place // 8  # ones still to pass, from the noted one on
        skip = place % 8
        while True:
            bits = np.unpackbits(self.upper[block : block + 64], bitorder="little")
            bits[:skip] = 0
            ones = np.flatnonzero(bits)
            if left < len(ones):
                place = block * 8 + int(ones[left])
                return (place - i) << self.low | int(self._low(i, 1)[0])
            left, block, skip = left - len(ones), block + 64, 0

    def __iter__(self) -> Iterator[int]:
        """The values in order, SAMPLE of them selected at a time from their noted place on."""
        for begin in range(0, self.n, SAMPLE):
            block, count = begin // SAMPLE, min(SAMPLE, self.n - begin)
            place = int(self.samples[block])
            stop = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.upper)
            bits = np.unpackbits(self.upper[place // 8 : -(-stop // 8)], bitorder="little")
            bits[: place % 8] = 0
            ones = np.flatnonzero(bits)[:count] + place // 8 * 8
            high = (ones - np.arange(begin, begin + count)).astype(np.uint64) << np.uint64(self.low)
            yield from (high | self._low(begin, count)).tolist()

    def values(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        return high | self._low(0, self.n)
