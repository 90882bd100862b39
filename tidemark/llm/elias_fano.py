"""Non-decreasing whole numbers in about 2 + log2(largest / count) bits each.

The low bits of each number lie in a row of equal fields. The high bits are a bit
vector: number i sets the bit at its high part plus i, so the place of the i-th set bit
(select) gives the high part back. Every 256th set bit's place is kept in 32 bits, from
which a search starts; there is no table of whole numbers.
"""

from __future__ import annotations

import struct

import numpy as np

STEP = 256
HEAD = struct.Struct("<QQBQ")  # count, largest, low bits, bytes of the bit vector

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
POPCOUNT = _ONES.sum(axis=1).astype(np.uint8)
# PLACE[b, r]: place of the r-th set bit of byte b (8 where it has fewer)
PLACE = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    _set = np.flatnonzero(_ONES[_byte])
    PLACE[_byte, : len(_set)] = _set


class EliasFano:
    """`EliasFano.of(values)` packs, `select` gives values back by index, `find` searches."""

    def __init__(self, count: int, largest: int, bits: int, low: bytes, high: bytes, samples: bytes):
        self.count, self.largest, self.bits = count, largest, bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values) -> EliasFano:
        """Of numbers from 0 on, each at least as large as the one before."""
        values = np.asarray(values, np.int64)
        if not len(values):
            return cls(0, 0, 0, b"", b"", b"")
        if values[0] < 0 or (np.diff(values) < 0).any():
            raise ValueError("numbers must not fall, nor lie below 0")
        count, largest = len(values), int(values[-1])
        bits = max(0, ((largest + 1) // count).bit_length() - 1)
        fields = (values[:, None] >> np.arange(bits)) & 1
        places = (values >> bits) + np.arange(count)
        if places[-1] >= 1 << 32:
            raise ValueError("too many numbers for 32-bit places")
        vector = np.zeros(int(places[-1]) + 1, np.uint8)
        vector[places] = 1

        def packed(array: np.ndarray) -> bytes:
            return np.packbits(array.astype(np.uint8), bitorder="little").tobytes()

        return cls(count, largest, bits, packed(fields.ravel()), packed(vector), places[::STEP].astype("<u4").tobytes())

    def __len__(self) -> int:
        return self.count

    def select(self, first: int, last: int | None = None) -> np.ndarray:
        """Numbers `first` to `last` (excluded; else all to the end).

        The search starts at the sample before `first` and ends at the one after `last`.
        """
        last = self.count if last is None else min(last, self.count)
        if not 0 <= first < last:
            return np.zeros(0, np.int64)
        sample = first // STEP
        start = int(self.samples[sample]) >> 3
        beyond = (last - 1) // STEP + 1
        end = (int(self.samples[beyond]) >> 3) + 1 if beyond < len(self.samples) else len(self.high)
        window = self.high[start:end]
        ones = np.cumsum(POPCOUNT[window], dtype=np.int64)
        # set bits of the window's first byte before the sample belong to earlier numbers
        earlier = int(POPCOUNT[window[0] & ((1 << (int(self.samples[sample]) & 7)) - 1)])
        wanted = np.arange(first, last) - sample * STEP + earlier
        byte = np.searchsorted(ones, wanted, side="right")
        rank = wanted - np.where(byte > 0, ones[byte - 1], 0)
        places = (start + byte) * 8 + PLACE[window[byte], rank]
        return ((places - np.arange(first, last)) << self.bits) | self._low(first, last)

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.bits:
            return np.zeros(last - first, np.int64)
        at = first * self.bits
        field = self.low[at >> 3 : (last * self.bits + 7) >> 3]
        bits = np.unpackbits(field, bitorder="little")[at & 7 :][: (last - first) * self.bits]
        return (bits.reshape(-1, self.bits).astype(np.int64) << np.arange(self.bits)).sum(axis=1)

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.count:
            raise IndexError(i)
        return int(self.select(i, i + 1)[0])

    def find(self, value: int) -> int:
        """Index of the first number not below `value`."""
        low, high = 0, self.count
        while low < high:
            middle = (low + high) // 2
            if self[middle] < value:
                low = middle + 1
            else:
                high = middle
        return low

    def to_bytes(self) -> bytes:
        head = HEAD.pack(self.count, self.largest, self.bits, len(self.high))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        """The numbers packed at `at`, and where what follows them begins."""
        count, largest, bits, n_high = HEAD.unpack_from(data, at)
        cuts = [at + HEAD.size]
        for n in ((count * bits + 7) // 8, n_high, -(-count // STEP) * 4):
            cuts.append(cuts[-1] + n)
        low, high, samples = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        return cls(count, largest, bits, low, high, samples), cuts[-1]
