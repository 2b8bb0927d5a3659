"""Non-decreasing numbers in about two bits more each than their mean gap needs."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<qqBxxxxxxx")
# Every so many numbers the place of their bit is kept, to start a search from.
SAMPLE = 256


class EliasFano:
    """Low bits are packed; high bits are a bit vector with one set bit for each number.

    Of every `SAMPLE`-th number the place of its bit is kept, in 32 bits, so a number is
    found by a look at few bytes. `select(i)` gives the i-th number, `some(i, n)` the n
    numbers from there on, `values()` all of them.
    """

    def __init__(self, count: int, first: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.first, self.low_bits = count, first, low_bits
        self.low, self.high = low, high
        self.samples = np.frombuffer(samples, dtype="<u4")

    @classmethod
    def build(cls, numbers: np.ndarray) -> EliasFano:
        count = len(numbers)
        if not count:
            return cls(0, 0, 0, b"", b"", b"")
        first = int(numbers[0])
        above = (numbers - first).astype(np.uint64)
        span = int(above[-1]) + 1
        low_bits = max(0, (span // count).bit_length() - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((above[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        places = (above >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        high = np.zeros(int(places[-1]) + 1, dtype=np.uint8)
        high[places] = 1
        pack = lambda bits: np.packbits(bits, bitorder="little").tobytes()
        samples = places[::SAMPLE].astype("<u4").tobytes()
        return cls(count, first, low_bits, pack(low.ravel()), pack(high), samples)

    def to_bytes(self) -> bytes:
        samples = self.samples.tobytes()
        sizes = struct.pack("<qqq", len(self.low), len(self.high), len(samples))
        head = _HEAD.pack(self.count, self.first, self.low_bits)
        return head + sizes + self.low + self.high + samples

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        count, first, low_bits = _HEAD.unpack_from(data)
        sizes = struct.unpack_from("<qqq", data, _HEAD.size)
        parts, at = [], _HEAD.size + 24
        for size in sizes:
            parts.append(data[at : at + size])
            at += size
        return cls(count, first, low_bits, *parts)

    def _lows(self, start: int, end: int) -> np.ndarray:
        from_bit, to_bit = start * self.low_bits, end * self.low_bits
        part = np.frombuffer(self.low[from_bit // 8 : -(-to_bit // 8)], dtype=np.uint8)
        bits = np.unpackbits(part, bitorder="little")[from_bit % 8 :][: to_bit - from_bit]
        weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        return bits.reshape(end - start, self.low_bits).astype(np.int64) @ weights

    def some(self, start: int, count: int) -> np.ndarray:
        """Numbers by place, from the sample before the first on."""
        if not count:
            return np.zeros(0, dtype=np.int64)
        if start < 0 or start + count > self.count:
            raise IndexError(start)
        sample = start // SAMPLE
        place = int(self.samples[sample])
        wanted = start - sample * SAMPLE + count
        byte, width = place // 8, wanted // 2 + 64
        while True:  # the bytes that hold so many set bits
            part = np.frombuffer(self.high[byte : byte + width], dtype=np.uint8)
            bits = np.unpackbits(part, bitorder="little")
            bits[: place - 8 * byte] = 0
            ones = np.flatnonzero(bits)
            if len(ones) >= wanted:
                break
            width *= 2
        highs = 8 * byte + ones[wanted - count : wanted] - np.arange(start, start + count)
        return self.first + (highs << self.low_bits) + self._lows(start, start + count)

    def values(self) -> np.ndarray:
        return self.some(0, self.count)

    def select(self, i: int) -> int:
        return int(self.some(i, 1)[0])
