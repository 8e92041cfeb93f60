"""Bounded stores of results by key, for the lifetime of a task or worker."""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa


class Store:
    """Keeps at most ``2 * bound`` entries: when ``bound`` new ones have come, all not used since the last time go."""

    def __init__(self, bound: int):
        self.bound = bound
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.bound:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def __len__(self) -> int:
        return len(self.young) + len(self.old)


#: Longest string, in bytes, that is its own key.
SHORT = 15


def string_hashes(strings: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of a 128-bit key of every string: no two different texts are known to share one.

    Strings up to ``SHORT`` bytes are their own key, with their length in the last byte, so none of them share it.
    Longer ones have 127 bits of a BLAKE2 digest; the first bit is set, which no short string's is.
    """
    if not len(strings):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    first, sizes = ends[:-1] - ends[0], np.diff(ends)
    own = (np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].tobytes() if data else b"") + bytes(16)
    words = np.ndarray((len(own) - 7,), "<u8", own, strides=(1,))  # the eight bytes from each place
    kept = lambda n: ~(np.uint64(2**64 - 1) << (8 * np.minimum(n, 7)).astype(np.uint64))
    low = np.where(sizes < 8, words[first] & kept(sizes), words[first])
    high = words[np.minimum(first + 8, len(words) - 1)] & np.where(sizes > 8, kept(np.clip(sizes - 8, 0, 7)), np.uint64(0))
    high |= np.minimum(sizes, SHORT).astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(sizes > SHORT)
    if len(long):
        digests = b"".join(
            hashlib.blake2b(own[a:b], digest_size=16).digest()
            for a, b in zip(first[long].tolist(), (first + sizes)[long].tolist())
        )
        halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
        low[long], high[long] = halves[:, 0], halves[:, 1] | np.uint64(1 << 63)
    low ^= mixed(high)  # both steps can be undone, so pairs stay apart, and each half alone almost always
    return low, high ^ mixed(low)


def mixed(numbers: np.ndarray) -> np.ndarray:
    out = (numbers ^ numbers >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    out = (out ^ out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


class PackedStore:
    """Lists of numbers by the two halves of a string's key, about 40 bytes an entry.

    Forgets everything when the bound is reached.
    """

    def __init__(self, bound: int):
        self.bound = bound
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each entry is, and whether it is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        last = len(self.keys) - 1
        at = np.minimum(np.searchsorted(self.keys, keys), last)
        there = (self.keys[at] == keys) & (self.checks[at] == checks)
        left = np.flatnonzero(~there & (self.keys[at] == keys))
        while len(left):  # others with the same first half
            at[left] = np.minimum(at[left] + 1, last)
            same = self.keys[at[left]] == keys[left]
            there[left] = same & (self.checks[at[left]] == checks[left])
            left = left[same & ~there[left] & (at[left] < last)]
        return at, there

    def add(self, keys: np.ndarray, checks: np.ndarray, values: list[list[int]]) -> None:
        """New entries. What was found before may be elsewhere afterwards."""
        sizes = np.fromiter(map(len, values), np.int32, len(values))
        numbers = np.fromiter(chain.from_iterable(values), np.uint32, int(sizes.sum()))
        if len(self.keys) + len(keys) > self.bound or self.used + len(numbers) > 16 * self.bound:
            self.clear()
        if self.used + len(numbers) > len(self.flat):
            self.flat = np.append(self.flat[:self.used], np.zeros(self.used // 2 + len(numbers), np.uint32))
        self.flat[self.used:self.used + len(numbers)] = numbers
        first = self.used + np.cumsum(sizes, dtype=np.int64) - sizes
        self.used += len(numbers)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys, self.checks = np.insert(self.keys, at, keys[order]), np.insert(self.checks, at, checks[order])
        self.first, self.sizes = np.insert(self.first, at, first[order]), np.insert(self.sizes, at, sizes[order])

    def lists_of(self, strings: pa.StringArray, compute) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(numbers, first, size)``: where in ``numbers`` each string's list is.

        ``compute`` makes the lists of those strings that aren't known.
        """
        keys, checks = string_hashes(strings)
        at, there = self.find(keys, checks)
        while not there.all():  # a second time if the store has just forgotten those found before
            new = np.flatnonzero(~there)
            self.add(keys[new], checks[new], compute(strings.take(pa.array(new)).to_pylist()))
            at, there = self.find(keys, checks)
        return self.flat, self.first[at], self.sizes[at].astype(np.int64)


def ragged(numbers: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return numbers[np.repeat(first - ends + sizes, sizes) + np.arange(total)], ends
