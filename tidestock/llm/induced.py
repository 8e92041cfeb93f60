"""Suffix and common-prefix order of one shard by induced sorting with spooled bucket queues.

Suffixes smaller than their successor are S-type, the others L-type; an S suffix after an L suffix
is LMS. Once the LMS suffixes are in order, a pass over the buckets (first characters) upwards
induces all L suffixes and a pass downwards all S suffixes: a sorted suffix puts its predecessor at
the end of the predecessor's bucket queue. The LMS order comes from the same two passes over LMS
substrings, which are then named; the string of names is sorted by recursion.

Queues carry ``(position, common prefix)`` tuples. The common prefix of two neighbours in a queue is
one more than the least common prefix between their sources, so it is carried along, not compared.
Queues beyond a memory budget go to a temporary file and are read back when their bucket's turn
comes; texts beyond it are mapped from one. The files are scratch of one task and vanish with it.
Only queues and text are spooled: types, runs, ranks and one whole bucket are arrays in memory, 39 bytes
at the peak for each byte of text (measured on shards of 1 and 4 MB). Callers bound the text.

Order and common prefixes are exact up to ``CAP`` characters; suffixes that agree further come in
any order. A whole bucket is handled at once, with one numpy operation for each step.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

CAP = 64
#: Bytes of queues that may stay in memory, and of a text before it is mapped from a file.
MEMORY = 96 << 20
#: Strings whose buckets hold fewer suffixes than this on average are ordered by doubling ranks.
DENSE = 64

Items = tuple[np.ndarray, np.ndarray]
NOTHING: Items = (np.zeros(0, np.int64), np.zeros(0, np.uint8))


class Queues:
    """A first-in first-out queue of items for each bucket, spooled to disk beyond the budget."""

    def __init__(self):
        self.held: dict[int, list] = defaultdict(list)
        self.in_memory = 0
        self.file = None

    def put(self, bucket: int, items: Items) -> None:
        self.held[bucket].append(items)
        self.in_memory += items[0].nbytes + items[1].nbytes
        if self.in_memory > MEMORY:
            self._spool()

    def _spool(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for bucket, chunks in self.held.items():
            for k, chunk in enumerate(chunks):
                if isinstance(chunk, tuple):
                    at = self.file.seek(0, 2)
                    chunk[0].tofile(self.file)
                    chunk[1].tofile(self.file)
                    self.file.flush()
                    chunks[k] = [at, len(chunk[0])]
        self.in_memory = 0

    def take(self, bucket: int) -> Items:
        chunks = self.held.pop(bucket, [])
        if not chunks:
            return NOTHING
        out = []
        for chunk in chunks:
            if isinstance(chunk, tuple):
                self.in_memory -= chunk[0].nbytes + chunk[1].nbytes
                out.append(chunk)
            else:
                self.file.seek(chunk[0])
                out.append((np.fromfile(self.file, np.int64, chunk[1]), np.fromfile(self.file, np.uint8, chunk[1])))
        return joined(out)


def joined(parts: list[Items]) -> Items:
    if len(parts) == 1:
        return parts[0]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class RangeMin:
    """Least common prefix between two places of a sequence: min of ``lcp[left + 1 .. right]``."""

    def __init__(self, lcp: np.ndarray):
        self.levels = [lcp]
        width = 1
        while 2 * width <= len(lcp):
            last = self.levels[-1]
            level = last.copy()
            np.minimum(last[:-width], last[width:], out=level[:-width])
            self.levels.append(level)
            width *= 2
        self.table = np.stack(self.levels) if len(lcp) else np.zeros((1, 0), np.uint8)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        level = np.frexp((right - left).astype(np.float64))[1] - 1
        return np.minimum(self.table[level, left + 1], self.table[level, right + 1 - (1 << level)])


def one_more(lcp: np.ndarray) -> np.ndarray:
    return np.minimum(lcp, CAP - 1) + np.uint8(1)


class Shape:
    """Types and runs of a text that ends with its one least character."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        turns = np.flatnonzero(text[1:] != text[:-1])
        rising = text[turns + 1] > text[turns]
        which = np.repeat(np.arange(len(turns)), np.diff(turns, prepend=-1))
        self.s = np.append(rising[which], True)
        self.run = np.minimum(np.append(turns[which] - np.arange(n - 1) + 1, 1), CAP).astype(np.uint8)
        self.lms = np.flatnonzero(self.s[1:] & ~self.s[:-1]) + 1


def _spread(text, sources: Items, wanted: np.ndarray, queues: Queues, carry: bool) -> None:
    """Put the predecessors of the wanted sources at the ends of their buckets."""
    place = np.flatnonzero(wanted)
    if not len(place):
        return
    before = sources[0][place] - 1
    bucket = text[before]
    order = np.argsort(bucket, kind="stable")
    place, before, bucket = place[order], before[order], bucket[order]
    edges = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    lcp = np.ones(len(place), np.uint8)
    if carry:
        same = np.flatnonzero(bucket[1:] == bucket[:-1])
        if len(same):
            lcp[same + 1] = one_more(RangeMin(sources[1])(place[same], place[same + 1]))
    starts = [0, *edges.tolist(), len(place)]
    for a, b in zip(starts, starts[1:]):
        queues.put(int(bucket[a]), (before[a:b], lcp[a:b]))


def _rounds(text, items: Items, bucket: int, carry: bool) -> Items:
    """A bucket's queue followed by what it induces in itself: one more of the bucket's character each round."""
    parts, count = [], 0
    while len(items[0]):
        parts.append(items)
        count += 1
        before = items[0] - 1
        place = np.flatnonzero((before >= 0) & (text[before] == bucket))
        lcp = np.full(len(place), min(count, CAP), np.uint8)
        if carry and len(place) > 1:
            lcp[1:] = one_more(RangeMin(items[1])(place[:-1], place[1:]))
        items = before[place], lcp
    return joined(parts) if parts else NOTHING


def induce(text: np.ndarray, shape: Shape, lms: np.ndarray, lcp: np.ndarray, carry: bool) -> Iterator[tuple[int, Items]]:
    """All suffixes from sorted LMS suffixes, as ``(bucket, (positions, common prefixes))`` downwards.

    Within a bucket items ascend; the first one's common prefix is meaningless.
    """
    buckets = np.unique(text)
    first = np.searchsorted(text[lms], buckets, side="left")
    last = np.searchsorted(text[lms], buckets, side="right")
    rising, lower = Queues(), Queues()
    for bucket, a, b in zip(buckets.tolist(), first.tolist(), last.tolist()):
        large = _rounds(text, rising.take(bucket), bucket, carry)
        seeds = lms[a:b], lcp[a:b].copy()
        if len(large[0]):
            lower.put(bucket, large)
            if len(seeds[0]):
                seeds[1][0] = min(shape.run[large[0][-1]], shape.run[seeds[0][0]])
        sources = joined([large, seeds])
        before = sources[0] - 1
        _spread(text, sources, (before >= 0) & (text[before] > bucket), rising, carry)
    falling = Queues()
    end = len(text) - 1
    for bucket in buckets[::-1].tolist():
        small = _rounds(text, falling.take(bucket), bucket, carry)
        if bucket == text[end]:
            small = np.array([end]), np.zeros(1, np.uint8)
        large = lower.take(bucket)
        border = 0
        if len(large[0]) and len(small[0]):
            border = min(shape.run[large[0][-1]], shape.run[small[0][-1]])
        back = np.append(np.uint8(border), large[1][:0:-1]) if len(large[0]) else large[1]
        sources = joined([small, (large[0][::-1], back)])
        before = sources[0] - 1
        _spread(text, sources, (before >= 0) & (text[before] < bucket), falling, carry)
        up = np.append(np.uint8(border), small[1][:0:-1]) if len(small[0]) else small[1]
        yield bucket, joined([large, (small[0][::-1], up)])


def name_substrings(text: np.ndarray, shape: Shape, order: np.ndarray) -> np.ndarray:
    """Names (ranks from 1) of the LMS substrings, in text order, from their sorted order."""
    lms = shape.lms
    rank_of = np.empty(len(text), np.int64)
    rank_of[lms] = np.arange(len(lms))
    stop = np.append(lms[1:], len(text) - 1)[rank_of[order]]  # where each substring ends, inclusive
    length = stop - order + 1
    differ = length[1:] != length[:-1]
    alive = np.flatnonzero(~differ)
    offset = 0
    while len(alive):
        alive = alive[length[alive] > offset]
        unequal = text[order[alive] + offset] != text[order[alive + 1] + offset]
        differ[alive[unequal]] = True
        alive = alive[~unequal]
        offset += 1
    names = np.empty(len(lms), np.int64)
    names[rank_of[order]] = np.cumsum(np.append(True, differ))
    return names


def ranks_by_doubling(names: np.ndarray, reach: int) -> np.ndarray:
    """Order of all suffixes of a string of names by their first ``reach`` names at least."""
    n = len(names)
    rank = names.astype(np.int64)
    width = 1
    while True:
        following = np.zeros(n, np.int64)
        following[:max(0, n - width)] = rank[width:]
        key = rank * (int(rank.max(initial=0)) + 2) + following
        order = np.argsort(key, kind="stable")
        step = np.append(True, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        width *= 2
        if width >= reach or step.all():
            return order


def sorted_lms(text: np.ndarray, shape: Shape) -> np.ndarray:
    """LMS suffixes in order, by naming their substrings and recursion on the names."""
    lms = shape.lms
    if len(lms) < 2:
        return lms
    seeds = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    parts = [items[0][is_lms[items[0]]] for _, items in induce(text, shape, seeds, np.zeros(len(seeds), np.uint8), carry=False)]
    order = np.concatenate(parts[::-1])
    names = name_substrings(text, shape, order)
    kinds = int(names.max())
    if kinds == len(names):
        return order
    if len(names) < DENSE * kinds:
        return lms[ranks_by_doubling(names, CAP)]
    inner = np.append(names, 0)  # its own least end
    return lms[full_order(inner)[1:]]


def full_order(text: np.ndarray) -> np.ndarray:
    shape = Shape(text)
    lms = sorted_lms(text, shape)
    parts = [items[0] for _, items in induce(text, shape, lms, np.zeros(len(lms), np.uint8), carry=False)]
    return np.concatenate(parts[::-1])


def common_prefixes(text: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common prefix of pairs of suffixes, up to ``CAP``."""
    out = np.zeros(len(left), np.uint8)
    alive = np.arange(len(left))
    for offset in range(CAP):
        a, b = left[alive] + offset, right[alive] + offset
        equal = np.maximum(a, b) < len(text)
        equal[equal] = text[a[equal]] == text[b[equal]]
        alive = alive[equal]
        if not len(alive):
            break
        out[alive] = offset + 1
    return out


def suffixes(text: np.ndarray) -> Iterator[tuple[int, Items]]:
    """All suffixes of ``text``, whose last character must be its one least, bucket by bucket downwards.

    Yields ``(first character, (positions ascending in order, common prefix with the one before))``.
    """
    if text.nbytes > MEMORY:
        mapped = np.memmap(tempfile.TemporaryFile(), text.dtype, "w+", shape=text.shape)
        mapped[:] = text
        text = mapped
    shape = Shape(text)
    lms = sorted_lms(text, shape)
    lcp = np.zeros(len(lms), np.uint8)
    lcp[1:] = common_prefixes(text, lms[:-1], lms[1:])
    yield from induce(text, shape, lms, lcp, carry=True)
