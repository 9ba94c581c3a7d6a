"""Elias-Fano sequences over numpy arrays, and a file of named arrays that can be memory mapped.

A non-decreasing sequence of n values up to u is kept as its low bits, packed, and its
high parts in unary: about 2 + log2(u / n) bits a value, with random access and search.
All operations work on arrays of positions or values at once.
"""

from __future__ import annotations

import json

import numpy as np

from snapstrata.llm.shared import mapped_array, open_output

_U = np.uint64
#: place of the r-th set bit of a byte
_PLACE = np.zeros((256, 8), dtype=np.int64)
for _byte in range(256):
    for _r, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        _PLACE[_byte, _r] = _bit


def encode(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of the sequence; universe is at least the last value."""
    n = len(values)
    values = values.astype(np.uint64)
    bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
    high = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
    flags = np.zeros(-(-(n + (universe >> bits) + 1) // 64) * 64, dtype=bool)
    flags[high] = True
    words = np.packbits(flags, bitorder="little").view("<u8")
    ones = np.bitwise_count(words).astype(np.int64)
    before = np.cumsum(ones) - ones
    return {
        "head": np.array([n, bits, universe], dtype="<i8"),
        "low": _pack(values & np.uint64((1 << bits) - 1), bits),
        "high": words,
        "ones": before.astype("<u4"),
        "zeros": (np.arange(len(words)) * 64 - before).astype("<u4"),
    }


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    out = []
    for at in range(0, len(values) if bits else 0, 1 << 15):
        chunk = values[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        out.append(np.packbits(np.unpackbits(chunk, axis=1, bitorder="little")[:, :bits], bitorder="little"))
    # room for reading eight bytes from any place
    return np.concatenate([*out, np.zeros(8, dtype=np.uint8)])


def _select(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th set bit of each word, by sums over the bytes of a word at once."""
    words, r = words.astype(np.uint64), r.astype(np.uint64)
    sums = words - ((words >> _U(1)) & _U(0x5555555555555555))
    sums = (sums & _U(0x3333333333333333)) + ((sums >> _U(2)) & _U(0x3333333333333333))
    # every byte holds the set bits up to its end
    sums = ((sums + (sums >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _U(0x0101010101010101)
    full = ((r * _U(0x0101010101010101) | _U(0x8080808080808080)) - sums) & _U(0x8080808080808080)
    place = np.bitwise_count(full).astype(np.uint64) << _U(3)
    rest = r - (((sums << _U(8)) >> place) & _U(0xFF))
    return (place + _PLACE[((words >> place) & _U(0xFF)).astype(np.int64), rest.astype(np.int64)].astype(np.uint64)).astype(np.int64)


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray]):
        n, bits, universe = arrays["head"].tolist()
        self.n, self.bits, self.universe = n, bits, universe
        low = arrays["low"]
        self.low = np.ndarray((max(1, len(low) - 7),), dtype="<u8", buffer=low, strides=(1,))
        self.high, self.ones, self.zeros = arrays["high"], arrays["ones"], arrays["zeros"]
        self.mask = np.uint64((1 << bits) - 1)

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.int64)
        at = i * self.bits
        return ((self.low[at >> 3] >> (at & 7).astype(np.uint64)) & self.mask).astype(np.int64)

    def select1(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i.astype("<u4"), side="right") - 1
        return 64 * word + _select(self.high[word], i - self.ones[word].astype(np.int64))

    def select0(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, i.astype("<u4"), side="right") - 1
        return 64 * word + _select(~self.high[word], i - self.zeros[word].astype(np.int64))

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self.select1(i) - i) << self.bits) | self.low_bits(i)

    def find(self, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The place of each value at or behind first and before last, or -1: a successor search."""
        high = value >> self.bits
        out = np.full(len(value), -1, dtype=np.int64)
        asked = np.flatnonzero((first < last) & (high <= self.universe >> self.bits))
        if not len(asked):
            return out
        high, want = high[asked], value[asked] & ((1 << self.bits) - 1)
        ahead = np.where(high > 0, self.select0(np.maximum(high - 1, 0)) - (high - 1), 0)
        start = np.maximum(ahead, first[asked])
        stop = np.minimum(self.select0(high) - high, last[asked])
        end = stop.copy()
        while True:
            open_ = np.flatnonzero(start < end)
            if not len(open_):
                break
            middle = (start[open_] + end[open_]) // 2
            below = self.low_bits(middle) < want[open_]
            start[open_] = np.where(below, middle + 1, start[open_])
            end[open_] = np.where(below, end[open_], middle)
        inside = np.flatnonzero(start < stop)
        hit = inside[self.low_bits(start[inside]) == want[inside]]
        out[asked[hit]] = start[hit]
        return out


def write_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """A file of named arrays: a header, then each array at a multiple of eight bytes."""
    layout, at = [], 0
    for name, array in arrays.items():
        layout.append((name, array.dtype.str, len(array), at))
        at += -(-array.nbytes // 8) * 8
    head = json.dumps(layout).encode()
    head += b" " * (-len(head) % 8)
    with open_output(uri) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for array in arrays.values():
            data = array.tobytes()
            out.write(data + b"\0" * (-len(data) % 8))


def map_arrays(uri: str) -> dict[str, np.ndarray]:
    data = mapped_array(uri, np.uint8)
    size = int.from_bytes(bytes(data[:8]), "little")
    body = data[8 + size :]
    return {
        name: body[at : at + n * np.dtype(kind).itemsize].view(kind)
        for name, kind, n, at in json.loads(bytes(data[8 : 8 + size]))
    }


def nested(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {f"{prefix}.{name}": array for name, array in arrays.items()}


def within(prefix: str, arrays: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {name.removeprefix(f"{prefix}."): array for name, array in arrays.items() if name.startswith(f"{prefix}.")}
