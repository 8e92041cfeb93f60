"""Removal of repeated byte strings across documents by suffix arrays of external induced sorting.

A byte goes if it lies in a string of ``LENGTH`` (50) bytes that also starts in a document with a
smaller id, judged on the input. Every start of such a string is a *window*.

1. Dealing. Each window picks one of its 29-byte substrings by its content alone (a mod-minimizer:
   the least hashed 7-byte substring, its place modulo 22). Equal windows pick equal substrings, so
   the picked substring's hash says where a window is compared. Neighbouring windows that pick the
   same one form a *fragment*, about 14 windows long; only its hashes and place are shuffled.
2. Equal fragments. Rows sorted by picked hash and fragment hash: of equal fragments only the
   smallest document's goes on, all windows of the others are repeats. A picked substring that one
   document alone has, and this is most of them, is done here.
3. Shards. Fragments whose picked substring other documents have too, in other fragments, are cut
   from the texts and dealt to shards by the picked hash. A shard's suffixes are sorted by external
   induced sorting (:mod:`tidestock.llm.induced`), which carries common prefixes along; in each run
   of suffixes with a common prefix of 50 or more, windows of all but the least document are repeats.
   A shard is held in memory. That is bounded because no picked hash has more than ``SHARD_BYTES`` there:
   a hot one is split by more of its windows' content, which equal windows share, and steps 2 and 3
   are taken for its parts (:func:`split_hot`).
4. Repeated windows are gathered per document; their union is removed.

Defined results: null and empty texts have no bytes; texts below 50 bytes stay whole; rows with equal
id are one document, so they don't remove each other's bytes; a null id comes first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm import induced
from tidestock.llm.rows import map_rows, staged_lean

LENGTH, PICKED, SEED = 50, 29, 7
STEP = PICKED - SEED
SHARD_BYTES = 1 << 20
#: Halvings of the places that the picked substring has in a window, until each is on its own.
LEVELS = (STEP - 1).bit_length()
#: Windows handled at a time, and rows of one picked hash that may wait for the next batch.
PIECE, WAITING = 1 << 18, 1 << 18
LOWEST = -(1 << 63)
U = np.uint64
BASE = 0x9E3779B97F4A7C15
WEIGHTS = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
POWERS = np.cumprod(np.append(U(1), np.full(PIECE + LENGTH + 1, BASE, U)))
INVERSES = np.cumprod(np.append(U(1), np.full(PIECE + LENGTH + 1, pow(BASE, -1, 1 << 64), U)))


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> U(31))) * U(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> U(29))) * U(0x94D049BB133111EB)
    return keys ^ (keys >> U(32))


def picks(data: bytes | np.ndarray, n: int) -> np.ndarray:
    """Place of the substring that each of the first ``n`` windows picks; ``data`` has 57 bytes more or zeros."""
    inner = LENGTH - SEED + 1
    seeds = np.ndarray((n + inner - 1,), "<u8", buffer=data, strides=(1,)) & U((1 << 8 * SEED) - 1)
    seeds = seeds * U(BASE)
    seeds = (seeds ^ (seeds >> U(32))) * U(0xD6E8FEB86659FD93)
    least = (seeds >> U(32) << U(32)) | np.arange(len(seeds), dtype=U)
    width = 1
    while 2 * width <= inner:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], least[inner - width:inner - width + n])
    place = (least & U(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(n)
    return window + (place - window) % STEP


def fragments(data: np.ndarray, ends: np.ndarray):
    """Fragments of concatenated documents that end at ``ends``.

    Yields arrays ``(picked hash, fragment hash, first window, windows)`` for a piece at a time.
    """
    padded = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])
    for start in range(0, len(data) - LENGTH + 1, PIECE):
        n = min(PIECE, len(data) - LENGTH + 1 - start)
        piece = padded[start:start + n + LENGTH + 8]
        valid = np.ones(n, bool)
        for end in ends[np.searchsorted(ends, start, "right"):].tolist():
            if end - LENGTH + 1 >= start + n:
                break
            valid[max(0, end - LENGTH + 1 - start):max(0, end - start)] = False
        place = picks(piece, n)
        turns = np.flatnonzero((place[1:] != place[:-1]) | (valid[1:] != valid[:-1])) + 1
        first = np.append(0, turns)
        count = np.diff(np.append(first, n))
        good = valid[first]
        first, count = first[good], count[good]
        if not len(first):
            continue
        sums = np.zeros(n + LENGTH, U)
        np.cumsum(WEIGHTS[piece[:n + LENGTH - 1]] * POWERS[:n + LENGTH - 1], out=sums[1:])
        at = place[first]
        picked = mixed((sums[at + PICKED] - sums[at]) * INVERSES[at])
        whole = mixed((sums[first + count + LENGTH - 1] - sums[first]) * INVERSES[first] + count.astype(U) * U(BASE))
        yield picked, whole, start + first, count


FRAGMENT = "picked int, whole long, key long, place long, n int"


def cut_fragments(docs: DataFrame) -> DataFrame:
    """``key, version, text`` to rows of fragments; ``place`` is the version (31 bits) and the start (32 bits)."""
    names = [f.split()[0] for f in FRAGMENT.split(", ")]

    def work(batches):
        for batch in batches:
            for top in range(0, batch.num_rows, 256):
                part = batch.slice(top, 256)
                text = part.column("text").cast(pa.large_binary())
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
                if offsets[-1] == offsets[0]:
                    continue
                data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
                offsets = offsets - offsets[0]
                key, version = part.column("key").to_numpy(), part.column("version").to_numpy()
                for picked, whole, first, count in fragments(data, offsets[1:]):
                    doc = np.searchsorted(offsets, first, "right") - 1
                    yield pa.RecordBatch.from_arrays([
                        pa.array((picked >> U(32)).astype(np.uint32).view(np.int32)), pa.array(whole.view(np.int64)),
                        pa.array(key[doc]), pa.array(version[doc] << 32 | (first - offsets[doc])), pa.array(count.astype(np.int32)),
                    ], names=names)

    return docs.mapInArrow(work, FRAGMENT)


class Pairing:
    """Streams fragments sorted by picked hash, fragment hash, windows, key and place.

    Yields ``(repeat, picked, key, place, n)`` arrays: fragments that are repeats as a whole, and those
    to be compared with others of the same picked hash. A hash with very many rows is handed on in
    parts; its first occurrences are then compared without checking whether they have company.
    """

    def __init__(self):
        self.open = None  # (picked, whole, n, first key) of a hash that was handed on unfinished

    def __call__(self, columns: list[np.ndarray], last: bool):
        """What can be said about these rows, and the rows that must wait for the next ones."""
        picked = columns[0]
        cut = len(picked)
        if not last and cut:
            start = int(np.searchsorted(picked, picked[-1], "left"))
            if cut - start < WAITING:
                cut = start
        return self._judge([c[:cut] for c in columns], cut < len(picked) or last), [c[cut:] for c in columns]

    def _judge(self, columns: list[np.ndarray], finished: bool):
        picked, whole, key, place, n = columns
        if not len(picked):
            return None
        new_hash = np.append(True, picked[1:] != picked[:-1])
        new = new_hash.copy()
        new[1:] |= (whole[1:] != whole[:-1]) | (n[1:] != n[:-1])
        leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        first_key = key[leader]
        going_on = self.open is not None and self.open[0] == picked[0]
        if going_on and self.open[1:3] == (whole[0], n[0]):
            first_key[leader == 0] = self.open[3]
        repeat = key > first_key
        starts = np.flatnonzero(new_hash)
        low, high = np.minimum.reduceat(first_key, starts), np.maximum.reduceat(first_key, starts)
        company = low != high
        if going_on:
            company[0] = True
        if finished:
            self.open = None
        else:
            company[-1] = True
            self.open = (picked[-1], whole[-1], n[-1], first_key[-1])
        use = repeat | company[np.cumsum(new_hash) - 1]
        return repeat[use], picked[use], key[use], place[use], n[use]


def pair_fragments(rows: DataFrame) -> DataFrame:
    """Rows ``repeat, picked, key, place, n`` from fragments dealt and sorted by their picked hash."""
    ordered = rows.repartition("picked").sortWithinPartitions("picked", "whole", "n", "key", "place")

    def work(batches):
        pairing = Pairing()
        waiting = None
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in range(5)]
            if waiting is not None and len(waiting[0]):
                columns = [np.concatenate(pair) for pair in zip(waiting, columns)]
            out, waiting = pairing(columns, last=False)
            waiting = [w.copy() for w in waiting]
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)
        if waiting is not None:
            out, _ = pairing(waiting, last=True)
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    names = ["repeat", "picked", "key", "place", "n"]
    return ordered.mapInArrow(work, "repeat boolean, picked int, key long, place long, n int")


def repeated_windows(bodies: list[bytes], keys: np.ndarray) -> np.ndarray:
    """For each byte of the joined bodies (one byte between): is it the start of a window that a smaller key has too?"""
    lengths = np.array([len(b) for b in bodies])
    ends = np.cumsum(lengths + 1) - 1
    data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    text = np.empty(len(data) + 1, np.uint16)
    text[:-1] = data
    text[:-1] += 2
    text[ends] = 1
    text[-1] = 0
    flagged = np.zeros(len(data), bool)
    for bucket, (places, lcp) in induced.suffixes(text):
        if bucket < 2 or len(places) < 2:
            continue
        owner = np.searchsorted(ends, places)
        fits = ends[owner] - places >= LENGTH
        new = np.append(True, lcp[1:] < LENGTH)
        starts = np.flatnonzero(new)
        own = np.where(fits, keys[owner], np.iinfo(np.int64).max)
        least = np.minimum.reduceat(own, starts)[np.cumsum(new) - 1]
        flagged[places[fits & (own > least)]] = True
    return flagged


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist()))


def cut_bodies(docs: DataFrame, wanted: DataFrame, emit: Callable, columns: str) -> DataFrame:
    """The rows that ``emit(picked, key, place, body)`` makes of each of the ``wanted`` fragments and its bytes."""
    version = F.shiftright("place", 32).alias("version")
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("start")
    own = wanted.select("key", version, F.struct(start, "n", "picked").alias("cut")).groupBy("key", "version").agg(
        F.collect_list("cut").alias("cuts")
    )

    def work(rows):
        for key, version, text, cuts in rows:
            data = text.encode()
            for c in cuts:
                a = c["start"]
                yield from emit(c["picked"], key, version << 32 | a, data[a:a + c["n"] + LENGTH - 1])

    return map_rows(docs.join(own, ["key", "version"]).select("key", "version", "text", "cuts"), work, columns)


def parts_of(body: bytes, level: int) -> list[tuple[int, int, int, int]]:
    """Parts ``(picked, whole, first window, windows)`` of a fragment, both hashes signed.

    The picked substring's place in the window, 0 to 21, falls into one of ``2 ** level`` ranges. What all
    windows of a range have in common, 39 bytes at level 1 and 50 at the last, names the part. Place and
    common bytes are content of the window, so equal windows meet again.
    """
    n, out = len(body) - LENGTH + 1, []
    picked = int(picks(body + bytes(8), 1)[0])
    first = 0
    while first < n:
        which = (picked - first << level) // STEP
        low, high = -(-which * STEP >> level), -(-(which + 1) * STEP >> level) - 1
        stop = min(n, picked - low + 1)
        common = bytes([low, high]) + body[picked - low:picked - high + LENGTH]
        name = lambda data, size: int.from_bytes(blake2b(data, digest_size=size).digest(), "little", signed=True)
        out.append((name(common, 4), name(body[first:stop + LENGTH - 1], 8), first, stop - first))
        first = stop
    return out


def hot_hashes(wanted: DataFrame) -> DataFrame:
    """``picked`` hashes with more bytes than a shard."""
    size = wanted.groupBy("picked").agg(F.sum(F.col("n") + LENGTH).alias("size"))
    return staged_lean(size.where(F.col("size") > SHARD_BYTES).select("picked"), "hot-fragments")


def split_hot(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``wanted`` with hot picked hashes split, and frames ``key, place, n`` of repeats found on the way.

    At the last level a part is one window and all its fragments are equal, so none but the least
    document's stays: no hash is hot then, however many documents have it.
    """
    cool, repeats = [], []
    for level in range(1, LEVELS + 1):
        hot = hot_hashes(wanted)
        if hot.isEmpty():
            break
        cool.append(wanted.join(hot, "picked", "left_anti").select("picked", "key", "place", "n"))

        def emit(_, key, place, body, level=level):
            for picked, whole, first, n in parts_of(body, level):
                yield picked, whole, key, place + first, n

        parts = cut_bodies(docs, wanted.join(hot, "picked", "left_semi"), emit, FRAGMENT)
        pairs = staged_lean(pair_fragments(parts), "fragments")
        repeats.append(pairs.where("repeat").select("key", "place", "n"))
        wanted = pairs.where("not repeat").select("picked", "key", "place", "n")
    return reduce(DataFrame.union, cool, wanted), repeats


def compare_shards(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Repeated windows ``key, place, n`` among the ``wanted`` fragments ``picked, key, place, n``."""
    size = wanted.agg(F.sum(F.col("n") + LENGTH)).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))

    def emit(picked, key, place, body):
        yield picked % shards, key, place, body

    bodies = cut_bodies(docs, wanted, emit, "shard int, key long, place long, body binary")

    def work(rows):
        for _, group in groupby(rows, key=lambda r: r[0]):
            held = list({(key, place): body for _, key, place, body in group}.items())
            keys = np.array([k for (k, _), _ in held])
            if keys.min() == keys.max():
                continue
            flagged = repeated_windows([b for _, b in held], keys)
            at = 0
            for (key, place), body in held:
                for first, n in _runs(flagged[at:at + len(body)]):
                    yield key, place + first, n
                at += len(body) + 1

    dealt = bodies.repartition("shard").sortWithinPartitions("shard")
    return map_rows(dealt, work, "key long, place long, n int")


def merged_bytes(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans; touching ones are one."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > stops[:-1])
    return starts[new], stops[np.append(new[1:], True)]


def repeated_spans(docs: DataFrame, finish, columns: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row ``key`` and the ``columns`` that ``finish(data, starts, stops)`` makes.

    ``data`` are the text's bytes, ``starts`` and ``stops`` the maximal spans to remove.
    """
    frame = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"),
        F.shiftrightunsigned(F.xxhash64(text_col), 33).alias("version"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    pairs = staged_lean(pair_fragments(cut_fragments(frame)), "fragments")
    wanted, repeats = split_hot(frame, pairs.where("not repeat").drop("repeat"))
    found = staged_lean(compare_shards(frame, wanted), "repeats")
    windows = reduce(DataFrame.union, repeats, pairs.where("repeat").select("key", "place", "n").union(found))
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).alias("start")
    own = windows.select("key", F.shiftright("place", 32).alias("version"), F.struct(start, "n").alias("w"))
    own = own.groupBy("key", "version").agg(F.collect_list("w.start").alias("starts"), F.collect_list("w.n").alias("counts"))

    def work(rows):
        for key, text, starts, counts in rows:
            first = np.array(starts or (), np.int64)
            yield (key, *finish(text.encode(), *merged_bytes(first, first + np.array(counts or (), np.int64) + LENGTH - 1)))

    joined = frame.join(own, ["key", "version"], "left").select("key", "text", "starts", "counts")
    return map_rows(joined, work, f"key long, {columns}")


def kept_bytes(data: bytes, starts: np.ndarray, stops: np.ndarray) -> bytes:
    """What is left of ``data``, concatenated."""
    edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
