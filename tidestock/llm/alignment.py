"""Cross-tokenizer alignment: groups of tokens between the byte offsets where tokens of both tokenizers end.

A is a byte-level tokenizer run on a space and the text, B a piece model run on the text (it adds the space itself).

*Fragments* form a monoid. The fragment of a byte range holds the tokens of both sides that end in it, cut at the
common ends: an open prefix (its group may have begun earlier), closed groups, an open suffix. Two neighbours compose
by joining the left suffix and the right prefix into one group; that is associative, a fragment without a common end is
one open piece, and the fragment of no bytes is neutral. So

1. Texts up to ``CHUNK`` bytes are one fragment, made where they are read.
2. Longer texts are cut into byte ranges wherever these fall. Each range goes to a task of its own, together with the
   rest of the stretches (see below) at its two ends, and keeps the tokens that end inside the range.
3. Fragments of a text meet ``FAN_IN`` at a time in a tree of Spark groups until each text has one.

A *stretch* begins before a space that follows no white space; no token of either side goes over such a place, so
stretches are encoded alone, each distinct one once, by the two libraries. Which of a text's tokens are where is
arithmetic on whole batches. A stretch longer than ``CHUNK`` stays in one range.

*Links* are all pairs of an A and a B token of one group. A pair of ids is counted once for each document that has it.
Documents are packed into blocks of bounded text with a table of the block's id pairs; only these tables are exploded,
counted over the corpus by shuffle, and looked up again for each block, so neither a document nor an id pair that all
documents share makes a large group.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte for byte, have no
tokens and no groups; texts and ids may repeat, every row counts as a document; a null id stays null.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidestock.llm.rows import ddl
from tidestock.llm.store import PackedStore, ragged
from tidestock.session import staged

MARK = "▁"
CHUNK, FAN_IN = 1 << 15, 8
#: Bytes of text that are aligned together, A tokens of a block, id pairs of one group that are listed singly.
TOGETHER, BLOCK, DIRECT = 1 << 19, 1 << 20, 1 << 12
MAX_STRETCHES = 300_000
BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
#: A space and Latin letters, then stops: two words for the merges of a byte-level tokenizer.
WORD = re.compile(r" ([A-Za-zÀ-ÖØ-öø-ɏ]+)([!-/:-@\[-`{-~]*)")
MAX_STOPS = 4096
BLANK_END, BAD = 1, 2
FRAGMENT = "ok boolean, a array<int>, b array<int>, a_sizes array<int>, b_sizes array<int>"
#: The same between the steps for long texts, each list as its :func:`packed` bytes.
PACKED = "ok boolean, a binary, b binary, a_sizes binary, b_sizes binary"


class PairEncoder:
    """Both tokenizers, the bytes of their ids, and a bounded store of stretches."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_file), sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        #: Fixed: how byte-level vocabularies write the 256 bytes.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in set(plain)]
        self.written = {b: chr(256 + k) for k, b in enumerate(moved)}
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}
        self.a_bytes = [bytes(byte_of.get(c, 63) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())]
        pieces = self.b.id_to_piece(list(range(self.b.get_piece_size())))
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
            else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_lengths, self.b_lengths = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        if self.b.normalize(" a  b ") != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("only piece models that keep spaces and add one in front are supported")
        if '"ByteLevel"' not in self.a.to_str() or self.a.normalizer is not None:
            raise ValueError("only byte-level tokenizers without normalisation are supported")
        if any(MARK in p[1:].lstrip(MARK) for p in pieces):
            raise ValueError("pieces with a space after another character are not supported")
        self.store = PackedStore(MAX_STRETCHES)
        self.space = self.b.piece_to_id(MARK)  # asked once, as the library takes long
        #: Whether the merges can be asked directly for the two parts of a :data:`WORD`, and the ids of stops.
        step = json.loads(self.a.to_str())["pre_tokenizer"]
        self.model, self.stops, self.direct = self.a.model, {}, (
            step["type"] == "ByteLevel" and step.get("use_regex", True) and not step["add_prefix_space"]
            and self.a.truncation is None and self.a.padding is None
            and all(t.special for t in self.a.get_added_tokens_decoder().values())
        )
        digits = [f"{i},".encode() for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.digits = np.frombuffer(b"".join(digits), np.uint8)
        self.digit_sizes = np.array(list(map(len, digits)), np.int64)
        self.digit_first = np.cumsum(self.digit_sizes) - self.digit_sizes

    def released(self) -> None:
        """At the end of a task: workers live on, so what they keep adds to the executor's memory in every later step."""
        self.store.clear()
        pa.default_memory_pool().release_unused()

    def encode_stretches(self, stretches: list[str]) -> list[list[int]]:
        """Flags, number of A ids, A ids and B ids of each; all begin with a space."""
        a, b = self.a_ids(stretches), self.b.encode([s[1:] for s in stretches], num_threads=1)
        if " " in stretches:
            b[stretches.index(" ")] = [self.space]
        bad = self.differing(stretches, a, self.a_bytes, self.a_lengths) | self.differing(stretches, b, self.b_bytes, self.b_lengths)
        flags = [BLANK_END * s[-1].isspace() for s in stretches]
        for k in np.flatnonzero(bad).tolist():
            flags[k] |= BAD
        return [[flag, len(x), *x, *y] for flag, x, y in zip(flags, a, b)]

    def a_ids(self, stretches: list[str]) -> list[list[int]]:
        """The library's A ids of each, for most without its way from text to words."""
        if not self.direct:
            return [e.ids for e in self.a.encode_batch(stretches, add_special_tokens=False)]
        tokenize, space = self.model.tokenize, self.written[32]
        out, others = [], []
        for s in stretches:
            found = WORD.fullmatch(s)
            if found is None:
                out.append(None)
                others.append(s)
                continue
            word, stops = found.groups()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(self.written)
            ids = [t.id for t in tokenize(space + word)]
            if stops:
                if stops not in self.stops:
                    if len(self.stops) >= MAX_STOPS:
                        self.stops.clear()
                    self.stops[stops] = [t.id for t in tokenize(stops)]
                ids += self.stops[stops]
            out.append(ids)
        rest = iter(self.a.encode_batch(others, add_special_tokens=False))
        return [next(rest).ids if ids is None else ids for ids in out]

    @staticmethod
    def differing(stretches: list[str], ids: list[list[int]], bytes_of: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """Which stretches their tokens don't give back."""
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
        sums = np.append(0, np.cumsum(lengths[flat]))[np.append(0, np.cumsum(counts))]
        whole = [s.encode() for s in stretches]
        out = np.diff(sums) != np.fromiter(map(len, whole), np.int64, len(whole))
        if out.any() or b"".join(map(bytes_of.__getitem__, flat.tolist())) != b"".join(whole):
            out = np.array([b"".join(map(bytes_of.__getitem__, x)) != w for x, w in zip(ids, whole)])
        return out

    def look_up(self, marked: list[str], separator: str) -> tuple[np.ndarray, ...]:
        """Where each text's stretches begin; for each stretch its flags, and where its ids are."""
        cut = pc.split_pattern(pa.array(marked, pa.string()), separator)
        coded = cut.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        flat, first, sizes = self.store.lists_of(coded.dictionary, self.encode_stretches)
        return cut.offsets.to_numpy(), flat, flat[first][which], flat[first + 1][which].astype(np.int64), first[which], sizes[which]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """For texts that begin with a space: whether both sides give them back, then ids and counts of A and of B."""
        separator = next(c for c in map(chr, range(0xD800)) if c != " " and not any(c in t for t in texts))
        marked = [" " + t[1:].replace(" ", separator + " ") for t in texts]
        starts, flat, flags, n_a, first, sizes = self.look_up(marked, separator)
        blank = flags & BLANK_END > 0
        blank[starts[1:] - 1] = False
        odd = np.flatnonzero(np.logical_or.reduceat(blank, starts[:-1]))
        if len(odd):  # white space before a space: such a place is no border
            for k in odd.tolist():
                marked[k] = separator.join(BEFORE_SPACE.split(texts[k]))
            starts, flat, flags, n_a, first, sizes = self.look_up(marked, separator)
        fine = ~np.logical_or.reduceat(flags & BAD > 0, starts[:-1])
        stays = np.repeat(fine, np.diff(starts))
        n_a, n_b = np.where(stays, n_a, 0), np.where(stays, sizes - 2 - n_a, 0)
        a, a_ends = ragged(flat, first + 2, n_a)
        b, b_ends = ragged(flat, first + sizes - n_b, n_b)
        return fine, a, np.diff(np.append(0, a_ends)[starts]), b, np.diff(np.append(0, b_ends)[starts])


@lru_cache(maxsize=1)
def pair_encoder(a_file: str, b_file: str) -> PairEncoder:
    return PairEncoder(a_file, b_file)


@dataclass
class Fragments:
    """Fragments of several ranges: flat ids, tokens of each range, flat sizes of pieces, pieces of each range."""

    ok: np.ndarray
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a_sizes: np.ndarray
    b_sizes: np.ndarray
    pieces: np.ndarray

    def arrays(self) -> list[pa.Array]:
        def lists(values, counts):
            ends = np.append(0, np.cumsum(counts)).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32, copy=False)))

        return [
            pa.array(self.ok), lists(self.a, self.n_a), lists(self.b, self.n_b),
            lists(self.a_sizes, self.pieces), lists(self.b_sizes, self.pieces),
        ]

    @classmethod
    def of(cls, columns: list[pa.Array]) -> Fragments:
        def lists(column):
            return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)

        ok, (a, n_a), (b, n_b), (a_sizes, pieces), (b_sizes, _) = columns[0].to_numpy(zero_copy_only=False), *map(lists, columns[1:])
        return cls(ok, a, b, n_a, n_b, a_sizes.astype(np.int64), b_sizes.astype(np.int64), pieces)

    def packed(self) -> list[pa.Array]:
        """As :data:`PACKED`: a third of the bytes, and nothing that Spark would copy number by number."""
        columns = [pa.array(self.ok)]
        for values, counts in ((self.a, self.n_a), (self.b, self.n_b), (self.a_sizes, self.pieces), (self.b_sizes, self.pieces)):
            columns.append(pa.array([packed(part) for part in np.split(values, np.cumsum(counts)[:-1])], pa.binary()))
        return columns

    @classmethod
    def of_packed(cls, columns: list[pa.Array]) -> Fragments:
        def lists(column):
            parts = [unpacked(data) for data in column.to_pylist()]
            return np.concatenate([np.zeros(0, np.int64), *parts]), np.fromiter(map(len, parts), np.int64, len(parts))

        ok, (a, n_a), (b, n_b), (a_sizes, pieces), (b_sizes, _) = columns[0].to_numpy(zero_copy_only=False), *map(lists, columns[1:])
        return cls(ok, a, b, n_a, n_b, a_sizes, b_sizes, pieces)

    def composed(self) -> Fragments:
        """All of them, in order, as one."""
        joined = []
        for sizes in (self.a_sizes, self.b_sizes):
            ends = np.cumsum(self.pieces)
            # the last piece of a range and the first of the next are one
            group = np.arange(len(sizes)) - np.searchsorted(ends[:-1], np.arange(len(sizes)), side="right")
            joined.append(np.bincount(group, sizes, int(ends[-1]) - len(ends) + 1).astype(np.int64))
        ok, one = bool(self.ok.all()), lambda x: np.array([x])
        return Fragments(one(ok), self.a, self.b, one(len(self.a)), one(len(self.b)), *joined, one(len(joined[0])))

    def closed(self) -> Fragments:
        """Fragments of whole texts as their groups; texts that failed somewhere have none."""
        good = self.ok.astype(bool)
        last = np.cumsum(self.pieces) - 1
        if (self.a_sizes[last][good].any() or self.b_sizes[last][good].any()):
            raise ValueError("a whole text ends in an open group")
        pieces = np.repeat(good, self.pieces)
        pieces[last] = False
        a, b = np.repeat(good, self.n_a), np.repeat(good, self.n_b)
        return Fragments(
            good, self.a[a], self.b[b], np.where(good, self.n_a, 0), np.where(good, self.n_b, 0),
            self.a_sizes[pieces], self.b_sizes[pieces], np.where(good, self.pieces - 1, 0),
        )

    def written(self, encoder: PairEncoder) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each text of closed groups."""
        a_ends, b_ends = np.cumsum(self.a_sizes), np.cumsum(self.b_sizes)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        at_a = np.arange(len(self.a)) + np.repeat(b_ends - self.b_sizes, self.a_sizes)
        at_b = np.arange(len(self.b)) + np.repeat(a_ends, self.b_sizes)
        order[at_a], order[at_b] = self.a, self.b
        text, ends = ragged(encoder.digits, encoder.digit_first[order], encoder.digit_sizes[order])
        if len(ends):
            text[ends[at_a[a_ends - 1]] - 1] = ord("|")
            text[ends[at_b[b_ends - 1]] - 1] = ord(";")
        bounds = np.append(0, ends)[np.append(0, np.cumsum(self.n_a + self.n_b))].tolist()
        whole = text.tobytes()
        return [whole[x:y - 1] if y > x else b"" for x, y in zip(bounds, bounds[1:])]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, id pair (A id in the upper half) and number of links, for all links of closed groups."""
        a_first, b_first = np.cumsum(self.a_sizes) - self.a_sizes, np.cumsum(self.b_sizes) - self.b_sizes
        text = np.repeat(np.arange(len(self.ok)), self.pieces)
        size = self.a_sizes * self.b_sizes
        own = np.flatnonzero(size <= DIRECT)
        group = np.repeat(own, size[own])
        place = np.arange(len(group)) - np.repeat(np.cumsum(size[own]) - size[own], size[own])
        a = self.a[a_first[group] + place // self.b_sizes[group]].astype(np.int64)
        b = self.b[b_first[group] + place % self.b_sizes[group]].astype(np.int64)
        texts, pairs, counts = [text[group]], [a << 32 | b], [np.ones(len(group), np.int64)]
        for g in np.flatnonzero(size > DIRECT).tolist():  # long groups: by distinct ids of both sides
            x, n_x = np.unique(self.a[a_first[g]:a_first[g] + self.a_sizes[g]].astype(np.int64), return_counts=True)
            y, n_y = np.unique(self.b[b_first[g]:b_first[g] + self.b_sizes[g]].astype(np.int64), return_counts=True)
            pairs.append((x[:, None] << 32 | y).ravel())
            counts.append(np.outer(n_x, n_y).ravel())
            texts.append(np.full(len(x) * len(y), text[g]))
        return np.concatenate(texts), np.concatenate(pairs), np.concatenate(counts)


def fragments_of(encoder: PairEncoder, windows: list[str], low: np.ndarray, high: np.ndarray) -> Fragments:
    """Fragments of the byte ranges ``(low, high]`` of texts that begin with a space and end where stretches do."""
    ok, a, n_a, b, n_b = encoder.encode(windows)
    sizes = np.add.reduceat(np.append(encoder.a_lengths[a], 0), np.cumsum(n_a) - n_a) * (n_a > 0)
    base = np.cumsum(sizes) - sizes
    kept = []
    for ids, counts, lengths in ((a, n_a, encoder.a_lengths), (b, n_b, encoder.b_lengths)):
        text, ends = np.repeat(np.arange(len(ok)), counts), np.cumsum(lengths[ids])
        inside = (ends > (base + low)[text]) & (ends <= (base + high)[text])
        kept.append((ids[inside], text[inside], ends[inside]))
    (a, a_text, a_ends), (b, b_text, b_ends) = kept
    total = int(sizes.sum()) + 1
    has_a, has_b = np.zeros(total, bool), np.zeros(total, bool)
    has_a[a_ends], has_b[b_ends] = True, True
    a_cut, b_cut = has_b[a_ends], has_a[b_ends]
    count = lambda text, w=None: np.bincount(text, w, len(ok)).astype(np.int64)
    pieces = count(a_text, a_cut) + 1
    n_pieces = int(pieces.sum())
    a_sizes = np.bincount(np.cumsum(a_cut) - a_cut + a_text, minlength=n_pieces)
    b_sizes = np.bincount(np.cumsum(b_cut) - b_cut + b_text, minlength=n_pieces)
    return Fragments(ok, a, b, count(a_text), count(b_text), a_sizes, b_sizes, pieces)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about ``TOGETHER`` bytes in a column of texts."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        part = (np.cumsum(sizes) - sizes) // TOGETHER
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:]):
            yield batch.slice(start, stop - start)


def aligned_batches(batches: Iterator[pa.RecordBatch], encoder: PairEncoder) -> Iterator[tuple[pa.Array, Fragments]]:
    """Keys and closed groups of batches of keys and whole texts."""
    for part in byte_slices(batches, 1):
        if part.num_rows:
            texts = [" " + (t or "") for t in part.column(1).to_pylist()]
            high = np.array([len(t.encode()) if t != " " else 0 for t in texts])
            found = fragments_of(encoder, texts, np.zeros(len(texts), np.int64), high)
            yield part.column(0), found.closed()


def byte_ranges(text: str) -> Iterator[tuple[str, int, int]]:
    """Windows of a text that begins with a space, and the byte range within each that is its own."""
    whole = text.encode()
    data = np.frombuffer(whole, np.uint8)
    byte_of = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
    cuts = byte_of[[0, *(m.start() for m in BEFORE_SPACE.finditer(text)), len(text)]]
    marks = np.arange(CHUNK, len(data), CHUNK)
    at = np.searchsorted(cuts, marks, side="right") - 1
    long = cuts[at + 1] - cuts[at] > CHUNK
    edges = np.unique(np.concatenate([[0], np.where(long, cuts[at + 1], marks), [len(data)]])).tolist()
    for low, high in zip(edges, edges[1:]):
        start = int(cuts[np.searchsorted(cuts, low, side="right") - 1])
        stop = int(cuts[np.searchsorted(cuts, high)])
        yield whole[start:stop].decode(), low - start, high - start


def long_texts(docs: DataFrame, files: tuple[str, str]) -> DataFrame:
    """``key`` and :data:`PACKED` columns, still open, of texts that are cut into ranges and composed again."""

    def cut(batches):
        number = TaskContext.get().partitionId() << 40
        for part in byte_slices(batches, 1):
            for k in range(part.num_rows):
                rows = list(byte_ranges(" " + part.column(1)[k].as_py()))
                keys = part.column(0).slice(k, 1).take(pa.array([0] * len(rows)))
                number += 1
                yield pa.RecordBatch.from_arrays([
                    keys, pa.array([number] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int64()),
                    *(pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))),
                ], names=["key", "row", "seq", "window", "low", "high"])

    def encode(batches):
        own = pair_encoder(*files)
        try:
            for part in byte_slices(batches, 3):
                if part.num_rows:
                    low, high = (part.column(k).to_numpy() for k in (4, 5))
                    found = fragments_of(own, part.column(3).to_pylist(), low, high)
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], *found.packed()], names=names)
        finally:
            own.released()

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("seq").combine_chunks()
        own = Fragments.of_packed([c.chunk(0) for c in table.columns[3:]]).composed()
        place = pa.array([table.column("seq")[0].as_py() // FAN_IN], pa.int64())
        return pa.Table.from_arrays([table.column(0).slice(0, 1), table.column(1).slice(0, 1), place, *own.packed()], names=names)

    key = ddl(docs.select("key"))
    names = ["key", "row", "seq", "ok", "a", "b", "a_sizes", "b_sizes"]
    kinds = f"{key}, row long, seq long, {PACKED}"
    windows = staged(docs.mapInArrow(cut, f"{key}, row long, seq long, window string, low long, high long"), "ranges")
    parts = staged(windows.repartition("row", "seq").mapInArrow(encode, kinds), "fragments")
    highest = parts.agg(F.max("seq")).first()[0]
    while highest:
        parts = parts.groupBy("row", F.floor(F.col("seq") / FAN_IN)).applyInArrow(meet, kinds)
        highest //= FAN_IN
    # written, so that no task holds the workers of two steps
    return staged(parts.select("key", "ok", "a", "b", "a_sizes", "b_sizes"), "composed")


def sources(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``key`` and ``text`` of texts that are one range, and of longer ones."""
    own = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    short = F.octet_length("text") < CHUNK
    return own.where(short), own.where(~short)


def align(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ok`` and the groups of each text: ids of both sides in order, and how many each group has."""
    short, long = sources(docs, id_col, text_col)
    files = a_file, b_file
    names = [id_col, "ok", "a", "b", "a_sizes", "b_sizes"]

    def whole(batches):
        own = pair_encoder(*files)
        try:
            for keys, found in aligned_batches(batches, own):
                yield pa.RecordBatch.from_arrays([keys, *found.arrays()], names=names)
        finally:
            own.released()

    def close(batches):
        for batch in batches:
            for part in fragment_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *Fragments.of_packed(part.columns[1:]).closed().arrays()], names=names)

    kinds = f"{ddl(docs.select(id_col))}, {FRAGMENT}"
    return short.mapInArrow(whole, kinds).unionByName(long_texts(long, files).mapInArrow(close, kinds))


def packed(numbers: np.ndarray) -> bytes:
    """Unsigned numbers in the fewest bytes that hold the largest, which are named first."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def link_blocks(
    docs: DataFrame, a_file: str, b_file: str, finish: Callable[[Fragments, PairEncoder], list[tuple]], columns: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Blocks of documents: each one's results of ``finish`` and its id pairs by place in the block's table. Written once."""
    short, long = sources(docs, id_col, text_col)
    files = a_file, b_file
    kinds = (
        f"block long, docs array<struct<{ddl(docs.select(F.col(id_col).alias('key')))}, {columns}>>, "
        "entries binary, places binary, links binary, pairs array<long>, holders array<int>"
    )

    def closed(number, some):
        keys, rows, text, pair, count = zip(*some)
        offsets = np.cumsum([0, *map(len, keys)])
        pairs, place = np.unique(np.concatenate(pair), return_inverse=True)
        entries = np.bincount(np.concatenate([t + o for t, o in zip(text, offsets)]), minlength=offsets[-1])
        docs = [(key, *values) for key, values in zip(chain(*keys), chain(*rows))]
        return (
            number, docs, packed(entries), packed(place), packed(np.concatenate(count)),
            pairs, np.bincount(place, minlength=len(pairs)).astype(np.int32),
        )

    def blocks(some, own):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for keys, found in some:
            text, pair, count = found.links()
            pairs, place = np.unique(pair, return_inverse=True)
            code = text * len(pairs) + place
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            count = np.add.reduceat(count[order], first) if len(first) else count
            held.append((keys.to_pylist(), finish(found, own), text[order[first]], pair[order[first]], count))
            size += len(found.a)
            if size >= BLOCK:
                yield closed(number, held)
                number, held, size = number + 1, [], 0
        if held:
            yield closed(number, held)

    def batch_of(row, schema):
        return pa.RecordBatch.from_arrays([
            pa.array([[dict(zip([f.name for f in schema[1].type.value_type], r)) for r in row[1]]], schema[1].type) if k == 1
            else pa.array([v], schema[k].type) for k, v in enumerate(row)
        ], schema=schema)

    schema = to_arrow_schema(T.StructType.fromDDL(kinds))

    def whole(batches):
        own = pair_encoder(*files)
        try:
            for row in blocks(aligned_batches(batches, own), own):
                yield batch_of(row, schema)
        finally:
            own.released()

    def composed(batches):
        own = pair_encoder(*files)
        some = ((b.column(0), Fragments.of_packed(b.columns[1:]).closed()) for batch in batches for b in fragment_slices(batch))
        for row in blocks(some, own):
            row = (row[0] + (1 << 31), *row[1:])  # apart from those of short texts
            yield batch_of(row, schema)

    both = short.mapInArrow(whole, kinds).union(long_texts(long, files).mapInArrow(composed, kinds))
    return staged(both, "link-blocks")


def fragment_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of packed fragments with a bounded number of A tokens, a row at least."""
    sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // (TOGETHER // 4)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for start, stop in zip(edges, edges[1:]):
        if stop > start:
            yield batch.slice(start, stop - start)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``a``, ``b``, ``n`` documents that hold it linked, and ``best``: whether no pair of its A id has more."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "holders")).alias("held"))
    counts = held.groupBy(F.col("held.pairs").alias("pair")).agg(F.sum("held.holders").alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select(
        "pair", "a", F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n", (F.col("n") == F.col("highest")).alias("best"),
    )


def document_links(blocks: DataFrame, columns: str) -> DataFrame:
    """For each document: ``key``, the ``columns`` of :func:`link_blocks`, ``n_links``, ``n_best`` and ``count_sum``."""
    table = blocks.select("block", F.explode("pairs").alias("pair")).join(pair_counts(blocks), "pair")
    known = table.select(F.col("block").alias("of"), "pair", (F.col("n") * 2 + F.col("best").cast("long")).alias("n"))
    own = blocks.select("block", "docs", "entries", "places", "links")
    key = blocks.schema["docs"].dataType.elementType["key"].dataType.simpleString()
    result = f"key {key}, {columns}, n_links long, n_best long, count_sum long"
    names = [name.strip().split()[0] for name in result.split(",")]

    def sums(block: pa.Table, known: pa.Table) -> pa.Table:
        """One block at a time: several in one Arrow batch would take memory by how many of them a task happens to get."""
        own = block.combine_chunks()
        docs, *data = (own.column(c).chunk(0) for c in ("docs", "entries", "places", "links"))
        entries, places, links = (unpacked(d[0].as_py()) for d in data)
        pair, n = (known.column(c).to_numpy() for c in ("pair", "n"))
        n = n[np.argsort(pair)]  # as in the block's table
        ends = np.append(0, np.cumsum(entries))

        def total(values):
            return pa.array(np.diff(np.append(0, np.cumsum(values))[ends]).astype(np.int64))

        return pa.Table.from_arrays([
            *docs.flatten().flatten(), total(links), total(links * (n & 1)[places]), total(links * (n >> 1)[places]),
        ], names=names)

    return own.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(sums, result)
