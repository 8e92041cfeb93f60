"""Token ids in patched frame-of-reference blocks.

Documents are range-partitioned by id, so that files follow each other in ascending order of ids;
each task encodes its documents with the tokenizers library, appends the end id and writes segments.
A segment holds whole documents and closes once it has ``SEGMENT_IDS`` ids. Its bytes, all little-endian:

    "PFOR", n_ids u32, n_docs u32, n_blocks u32
    doc_ids i64 x n_docs, null flags u8 x n_docs, lengths u32 x n_docs
    block starts u32 x n_blocks            (where each block begins, counted from the first)
    blocks: minimum u32, width u8, n_exceptions u8, 128 offsets packed at that width,
            exception places u8 x n, exception offsets u32 x n

A block is 128 ids less their minimum. Its width holds the 90th percentile of these offsets; larger
ones are exceptions, listed after the packed bits. The last block is filled up with its minimum.

Segments are rows of a Parquet table in the shared folder: any store that Spark writes to will do,
failed tasks leave nothing half-written, and readers find a block through the segment's index.
Positions over the whole corpus need one total for each partition, which is all the driver sees.

Defined results: null and empty texts have the end id only; a null document id sorts first and is
read back as null; repeated ids and rows are written each, ties in the order of the text's checksum.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import map_rows, together
from tidestock.llm.store import PackedStore, ragged
from tidestock.session import staged

BLOCK, SEGMENT_IDS, PERCENTILE = 128, 1 << 16, 90
MAX_STRETCHES = 1_500_000
#: Fixed pattern of the byte-level vocabulary: what splits a text before the merges.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
INNER_SPACE = re.compile(r"\s")
#: Marks of a stretch: white space that may meet other, nothing at all, a stop first, no letter or digit last.
BLANK, EMPTY, STOP, OPEN = 1, 2, 4, 8
#: Characters that are encoded together.
TOGETHER = 2 << 20
SEGMENTS = "part int, seq int, before long, n_ids long, payload binary"


def marks_of(text: str) -> int:
    blank = text == " " or text != "\n" and (INNER_SPACE.search(text, 1) or text[0] != " " and text[0].isspace())
    return BLANK * bool(blank) | STOP * (text[0] in ".,") | OPEN * (not text[-1].isalnum())


class WordEncoder:
    """The library's ids by stretch: each distinct stretch of some texts is encoded once.

    In a text without two white spaces in a row, every match of the pattern ends before a space, before
    and after a line end, and before a full stop or comma that follows a letter or digit. Such texts
    are cut there, and the ids of stretches are kept in a bounded store; other texts are cut into matches.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        #: Fixed: how the byte-level vocabulary writes the 256 bytes.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        moved = [b for b in range(256) if b not in set(plain)]
        self.written = {b: chr(256 + k) for k, b in enumerate(moved)}
        self.store = PackedStore(MAX_STRETCHES)

    def ids_of(self, match: str) -> list[int]:
        """Ids of one match of the pattern."""
        written = match.encode().decode("latin-1").translate(self.written)
        return [t.id for t in self.model.tokenize(written)]

    def stretches(self, texts: list[str]) -> list[list[int]]:
        """Marks, then the ids of the matches, of each stretch of one or more whole matches."""
        tokenize, space = self.model.tokenize, self.written[32]
        out = []
        for text in texts:
            body = text[1:] if text[:1] == " " else text
            if body.isalpha() and body.isascii():  # one match, written as it is but for the space
                out.append([0, *[t.id for t in tokenize(body if body is text else space + body)]])
            elif not text:
                out.append([EMPTY])
            else:
                out.append([marks_of(text), *[i for match in WORDS.findall(text) for i in self.ids_of(match)]])
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, equal to the library's with ``add_special_tokens=False``."""
        if any(a in text for a in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array([i for match in WORDS.findall(text) for i in self.ids_of(match)], "<u4")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """:meth:`encode` of each text, by their distinct stretches."""
        if not texts:
            return []
        odd = np.array(["\0" in t or any(a in t for a in self.added) for t in texts])
        marked = [
            "" if o else t.replace(" ", "\0 ").replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,")
            for t, o in zip(texts, odd)
        ]
        cut = pc.split_pattern(pa.array(marked, pa.string()), "\0")
        starts = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        flat, first, sizes = self.store.lists_of(coded.dictionary, self.stretches)
        marks, first, sizes = flat[first], first + 1, sizes - 1

        # a text is odd, too, if two white spaces meet or a stop doesn't follow a letter or digit
        own = marks[which]
        bad = own & (BLANK | EMPTY) > 0
        edge = np.append(starts[:-1], starts[1:] - 1)
        bad[edge] = own[edge] & BLANK > 0
        after = (own[1:] & STOP > 0) & (own[:-1] & OPEN > 0)
        after[starts[1:-1] - 1] = False
        bad[1:] |= after
        odd |= np.logical_or.reduceat(bad, starts[:-1])

        ids, ends = ragged(flat, first[which], sizes[which])
        bounds = np.append(0, ends)[starts]
        return [self.encode(t) if o else ids[a:b] for t, o, a, b in zip(texts, odd.tolist(), bounds.tolist(), bounds[1:].tolist())]


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts and the blocks' bytes."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.zeros(0, "<u4"), b""
    padded = np.empty(n_blocks * BLOCK, np.uint32)
    padded[:len(ids)] = ids
    padded[len(ids):] = ids[(n_blocks - 1) * BLOCK:].min()
    rows = padded.reshape(n_blocks, BLOCK)
    lowest = rows.min(axis=1)
    offsets = rows - lowest[:, None]
    rank = BLOCK * PERCENTILE // 100 - 1
    widths = bit_lengths(np.partition(offsets, rank, axis=1)[:, rank])
    outliers = (offsets >> np.minimum(widths, 31)[:, None] > 0) & (widths < 32)[:, None]
    bodies: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths).tolist():
        own = np.flatnonzero(widths == width)
        inside = np.where(outliers[own], 0, offsets[own])
        bits = np.unpackbits(inside.astype("<u4").ravel().view(np.uint8), bitorder="little").reshape(-1, 32)[:, :width]
        packed = np.packbits(bits.reshape(len(own), -1), axis=1)
        for k, body in zip(own.tolist(), packed):
            bodies[k] = body.tobytes()
    counts = outliers.sum(axis=1)
    at, place = np.nonzero(outliers)
    places, large = place.astype(np.uint8).tobytes(), offsets[at, place].astype("<u4").tobytes()
    out, starts, size, seen = [], [], 0, 0
    for low, width, n, body in zip(lowest.tolist(), widths.tolist(), counts.tolist(), bodies):
        block = struct.pack("<IBB", low, width, n) + body + places[seen:seen + n] + large[4 * seen:4 * (seen + n)]
        starts.append(size)
        out.append(block)
        size += len(block)
        seen += n
    return np.array(starts, "<u4"), b"".join(out)


def unpack_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks that begin at ``starts``, a row each; blocks of one width go together."""
    every = np.frombuffer(data, np.uint8)
    lowest = every[starts[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    widths, counts = every[starts + 4].astype(np.int64), every[starts + 5].astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]).tolist():
        own = np.flatnonzero(widths == width)
        packed = every[starts[own][:, None] + 6 + np.arange(BLOCK * width // 8)]
        kind = "<u2" if width <= 16 else "<u4"
        bits = np.zeros((len(own) * BLOCK, 8 * int(kind[-1])), np.uint8)
        bits[:, :width] = np.unpackbits(packed.ravel()).reshape(-1, width)
        out[own] = np.packbits(bits.ravel(), bitorder="little").view(kind).reshape(len(own), BLOCK)
    for k in np.flatnonzero(counts).tolist():
        at, n = int(starts[k]) + 6 + BLOCK * int(widths[k]) // 8, int(counts[k])
        out[k, every[at:at + n]] = np.frombuffer(data, "<u4", n, at + n)
    return out + lowest[:, None]


def write_segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    every = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts, blocks = pack_blocks(every)
    return b"".join([
        struct.pack("<4sIII", b"PFOR", len(every), len(doc_ids), len(starts)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in ids], "<u4").tobytes(),
        starts.tobytes(), blocks,
    ])


class Segment:
    """Reads a segment; ``ids(a, b)`` touches only the blocks of that range."""

    def __init__(self, payload: bytes):
        magic, self.n_ids, n_docs, n_blocks = struct.unpack_from("<4sIII", payload, 0)
        if magic != b"PFOR":
            raise ValueError("not a segment")
        at = 16
        parts = []
        for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", n_blocks)):
            parts.append(np.frombuffer(payload, kind, n, at))
            at += parts[-1].nbytes
        keys, nulls, self.lengths, self.block_starts = parts
        self.doc_ids = [None if null else key for key, null in zip(keys.tolist(), nulls.tolist())]
        self.payload, self.first = payload, at

    def ids(self, start: int, stop: int) -> np.ndarray:
        starts = self.block_starts[start // BLOCK:-(-stop // BLOCK)].astype(np.int64) + self.first
        every = unpack_blocks(self.payload, starts).ravel() if len(starts) else np.zeros(0, np.uint32)
        skipped = start // BLOCK * BLOCK
        return every[start - skipped:stop - skipped]

    def documents(self):
        """``(doc_id, place in the segment, ids)`` in order."""
        every, at = self.ids(0, self.n_ids), 0
        for key, n in zip(self.doc_ids, self.lengths.tolist()):
            yield key, at, every[at:at + n]
            at += n


def write_tokens(
    docs: DataFrame, tokenizer_file: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Encode all documents and write their segments; returns the written table."""
    source = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(text_col, F.lit("")).alias("body"))
    tie = F.crc32(F.col("body").cast("binary"))
    ordered = source.repartitionByRange("key", tie).sortWithinPartitions("key", tie)

    def work(rows):
        own, part = encoder(tokenizer_file), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        keys, arrays, held, seq, before = [], [], 0, 0, 0
        for some in together(rows, TOGETHER):
            for (key, _), ids in zip(some, own.encode_all([text for _, text in some])):
                keys.append(key)
                arrays.append(np.concatenate([ids, end]))
                held += len(ids) + 1
                if held >= SEGMENT_IDS:
                    yield part, seq, before, held, write_segment(keys, arrays)
                    before += held
                    keys, arrays, held, seq = [], [], 0, seq + 1
        if keys:
            yield part, seq, before, held, write_segment(keys, arrays)

    return staged(map_rows(ordered, work, SEGMENTS), "token-files")


def read_tokens(segments: DataFrame, finish, columns: str) -> DataFrame:
    """``doc_id``, ``start`` and the ``columns`` that ``finish(ids)`` makes of each document's ids."""
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    base, so_far = {}, 0
    for r in totals:
        base[r["part"]] = so_far
        so_far += r["n"]

    def work(rows):
        for part, before, payload in rows:
            first = base[part] + before
            for key, at, ids in Segment(payload).documents():
                yield (key, first + at, *finish(ids))

    return map_rows(segments.select("part", "before", "payload"), work, f"doc_id long, start long, {columns}")
