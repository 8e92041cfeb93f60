"""Pair-merge pieces (SentencePiece BPE models): encoding by a prefix table, decoding by the library.

In a pair-merge vocabulary every prefix of a text has exactly one last token: the one piece that
ends there and whose pair with the last token of what precedes it is *compatible*, which means that
merging the two pieces' characters from scratch gives back just these two pieces. That holds unless
some merge across their border comes before the merges that use up its two sides, which the chains
of last and first halves of both pieces tell (:meth:`PieceCodec.fits`). So one pass fills a table: an automaton reports all pieces that end at each character, pair tests pick the one, and
walking the table backwards from the end recovers the ids. Time grows with the text's length times
the pieces per end, however long a run without spaces is.

Two neighbouring characters that are neighbours in no piece are never joined, so a text falls into
parts there (for the given vocabularies: before a space mark, at line ends, around most punctuation)
whose encodings are independent. Each task keeps bounded stores of parts and pair tests.

Characters outside the vocabulary become their UTF-8 bytes. Encoding has no begin or end ids and
no sampling.

Defined results: null and empty texts have no ids; repeated rows are encoded each.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from tidestock.llm.rows import ddl, map_rows, together
from tidestock.llm.store import PackedStore, Store, ragged

MARK = "\u2581"
NEVER = float("-inf")
#: Bounds of a task's stores.
MAX_PARTS, MAX_PAIRS = 2_000_000, 100_000
#: Characters that are encoded together.
TOGETHER = 1 << 20


class PieceCodec:
    """Vocabulary, automaton and stores of one model file."""

    def __init__(self, model_file: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        byte_ids = [0] * 256
        for i, piece in enumerate(lib.id_to_piece(list(range(lib.get_piece_size())))):
            if lib.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.rank[piece] = lib.get_score(i)
                self.ids[piece] = i
        if lib.normalize(" a  b ") != f"{MARK}{MARK}a{MARK}{MARK}b{MARK}":
            raise ValueError("only models that keep spaces and add one in front are supported")
        self.byte_ids = byte_ids
        self.neighbours = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.by_word = not any(n[1] == MARK and n[0] != MARK or "\n" in n for n in self.neighbours)
        before = "".join(sorted({n[0] for n in self.neighbours if n[1] in ".,"} - {MARK}))
        #: Where a part may go on into a full stop or comma.
        self.into_stop = re.compile(f"[{re.escape(before)} ][.,]")
        self.borders: tuple[dict, dict] = ({}, {})
        #: Pieces that merging can make at all.
        self.whole = {p for p in self.ids if len(p) == 1 or self.merged(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.whole:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.decimal = [str(i) for i in range(lib.get_piece_size())]
        self.pairs, self.parts = Store(MAX_PAIRS), PackedStore(MAX_PARTS)

    def merged(self, text: str) -> list[str]:
        """The definition: merge the best adjacent pair, leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                rank = self.rank.get(parts[k] + parts[k + 1])
                if rank is not None and (best is None or rank > best):
                    best, at = rank, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces of a piece's last merge, if both rank before the piece itself."""
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            at = ranks.index(max(ranks))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        ordered = all(len(p) == 1 or self.rank.get(p, NEVER) > self.rank[piece] for p in parts)
        return (parts[0], parts[1]) if ordered else None

    def border(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """What stands at one border of a piece while it is merged, each with the rank that uses it up.

        None if the merges of the piece don't come in the order of ranks.
        """
        known = self.borders[side].get(piece)
        if known is None:
            if len(piece) == 1:
                known = [(piece, NEVER)]
            elif halves := self.halves(piece):
                inner = self.border(halves[side], side)
                if inner is not None:
                    known = [(piece, NEVER), (halves[side], self.rank[piece]), *inner[1:]]
            self.borders[side][piece] = known if known is not None else ()
        return known or None

    def fits(self, left: str, right: str) -> bool:
        """Whether no merge across the border of two pieces comes before those on its sides."""
        a, b = self.border(left, 1), self.border(right, 0)
        if a is None or b is None:
            return self.merged(left + right) == [left, right]
        rank = self.rank.get
        for x, used_x in a:
            for y, used_y in b:
                across = rank(x + y)
                if across is not None and across > used_x and across >= used_y:
                    return False
        return True

    def follows(self, pair: tuple[str, str]) -> bool:
        """:meth:`fits` by the store."""
        known = self.pairs.get(pair)
        if known is None:
            known = self.fits(*pair)
            self.pairs.put(pair, known)
        return known

    def single(self, before: str, character: str) -> str:
        """The last token where no longer piece can be one."""
        if before and not self.follows((before, character)):
            raise ValueError(f"no last token after {before!r} for {character!r}")
        return character

    def pieces(self, text: str) -> list[str]:
        """Pieces of one part by the table of last tokens."""
        n = len(text)
        if n == 1:
            return [text]
        last = [""] * (n + 1)
        known, follows = self.pairs.young.get, self.follows
        done = 0
        for end, length in self.automaton.iter(text):  # by end, the longest first
            end += 1
            while done < end - 1:  # no piece of several characters ends there
                done += 1
                if not last[done]:
                    last[done] = self.single(last[done - 1], text[done - 1])
            if last[end]:
                continue
            before = last[end - length]
            if before:
                pair = before, text[end - length:end]
                good = known(pair)
                if good or good is None and follows(pair):
                    last[end] = pair[1]
            elif length == end:
                last[end] = text[:end]
        while done < n:
            done += 1
            if not last[done]:
                last[done] = self.single(last[done - 1], text[done - 1])
        out, end = [], n
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def part(self, text: str) -> list[int]:
        """Ids of a part."""
        ids: list[int] = []
        for piece in self.pieces(text):
            own = self.ids.get(piece)
            if own is None:
                ids.extend(self.byte_ids[b] for b in piece.encode())
            else:
                ids.append(own)
        return ids

    def encode(self, text: str | None) -> list[int]:
        """All ids of a text."""
        return self.ids_of(MARK + text.replace(" ", MARK)) if text else []

    def ids_of(self, text: str) -> list[int]:
        """Ids of any text that begins and ends where parts do."""
        if not self.by_word:
            return self.part(text) if text else []
        out, start = [], 0
        for k in range(1, len(text)):
            if text[k - 1:k + 1] not in self.neighbours:
                out += self.part(text[start:k])
                start = k
        return out + self.part(text[start:]) if text else out

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """:meth:`encode` of each text, by the distinct stretches between spaces, line ends, stops and commas."""
        if not texts:
            return []
        odd = [
            not t or not self.by_word or "  " in t or t[0] in " .," or MARK in t or "\0" in t or bool(self.into_stop.search(t))
            for t in texts
        ]
        marked = [
            "" if o else (MARK + t.replace(" ", f"\0{MARK}")).replace("\n", "\0\n\0").replace(".", "\0.").replace(",", "\0,")
            for t, o in zip(texts, odd)
        ]
        cut = pc.split_pattern(pa.array(marked, pa.string()), "\0")
        coded = cut.flatten().dictionary_encode()
        which = coded.indices.to_numpy()
        flat, first, sizes = self.parts.lists_of(coded.dictionary, lambda new: [self.ids_of(t) for t in new])
        ids, ends = ragged(flat, first[which], sizes[which])
        bounds = np.append(0, ends)[cut.offsets.to_numpy()].tolist()
        return [np.array(self.encode(t), np.uint32) if o else ids[a:b] for t, o, a, b in zip(texts, odd, bounds, bounds[1:])]

    def as_decimal(self, ids: list[int]) -> str:
        """Ids as decimal numbers joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec for each worker and model file."""
    return PieceCodec(model_file)


def encoded(
    docs: DataFrame, model_file: str, finish: Callable[[PieceCodec, list[int]], tuple], columns: str,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``id_col`` and the ``columns`` that ``finish(codec, ids)`` makes of each text's ids."""
    source = docs.select(id_col, text_col)

    def work(rows):
        own = codec(model_file)
        try:
            for some in together(rows, TOGETHER):
                for (key, _), ids in zip(some, own.encode_all([text or "" for _, text in some])):
                    yield (key, *finish(own, ids.tolist()))
        finally:  # workers outlive tasks; what they hold meanwhile is memory that others need
            own.parts.clear()
            own.pairs = Store(MAX_PAIRS)

    return map_rows(source, work, f"{ddl(source.drop(text_col))}, {columns}")


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids``."""
    return encoded(docs, model_file, lambda _, ids: (ids,), "ids array<int>", id_col, text_col)
