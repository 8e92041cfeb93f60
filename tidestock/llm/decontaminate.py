"""Benchmark decontamination with a generalised suffix automaton over the words of all items.

The words of every item are added to one automaton; a state stands for all word sequences with
the same set of end places. A document's words are streamed through it, which keeps the length of
the longest suffix read so far that occurs in some item. Where that length reaches the window, the
last ``window`` words are an item window; items with fewer words count as one window each and are
found through the suffix links. Removed spans are the union of all found windows.

The automaton is built in each worker from the items' words, which are sent along with the task:
blocks of at most ``BLOCK_WORDS`` item words, one pass over the documents per block. So what a
worker holds has a fixed bound and any number of items is handled.

Defined results: null texts and texts without words have none (documents: clean; items: never
found); repeated items are found each under their id; a null item id sorts as the text "null".
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import ddl, map_rows, numbered
from tidestock.session import staged

BLOCK_WORDS = 200_000
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Bytes that separate words become spaces and A-Z become a-z; every byte from 0x80 up is part of a word.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def folded_words(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z in lower case, as UTF-8."""
    return (text or "").encode().translate(FOLD).split()


class ItemAutomaton:
    """Generalised suffix automaton over word sequences, with the items of each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._add(last, word)
        self.items: list[set[str]] = [set() for _ in self.link]
        self.short: dict[int, dict[int, set[str]]] = {}  # state -> length of a whole short item -> items
        for name, words in items:
            state = 0
            for word in words:
                state = self.next[state][word]
                up = state
                while up > 0 and self.length[up] >= window and name not in self.items[up]:
                    self.items[up].add(name)
                    up = self.link[up]
            if 0 < len(words) < window:
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(name)
        self.has_short = [False] * len(self.link)  # on the way up from here a short item ends
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.has_short[state] = state in self.short or self.has_short[self.link[state]]

    def _state(self, following: dict, link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, target: int, word: bytes) -> int:
        """State for the words that ``state`` reaches by ``word``, apart from longer ones of ``target``."""
        if self.length[target] == self.length[state] + 1:
            return target
        twin = self._state(dict(self.next[target]), self.link[target], self.length[state] + 1)
        self.link[target] = twin
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = twin
            state = self.link[state]
        return twin

    def _add(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, known, word)
        new = self._state({}, 0, self.length[last] + 1)
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, self.next[last][word], word)
        return new

    def matches(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit spans ``(first word, end)`` and the items found."""
        following, link, length, window, has_short = self.next, self.link, self.length, self.window, self.has_short
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        state = size = 0
        for place, word in enumerate(words, 1):
            step = following[state].get(word)
            if step is None:
                while state and step is None:
                    state = link[state]
                    step = following[state].get(word)
                if step is None:
                    size = 0
                    continue
                size = length[state] + 1
            else:
                size += 1
            state = step
            hit = 0
            if size >= window:
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                found |= self.items[up]
                hit = window
            if has_short[state]:
                up = state
                while up:
                    for n, names in self.short.get(up, {}).items():
                        if n <= size:
                            found |= names
                            hit = max(hit, n)
                    up = link[up]
            if hit:
                start = place - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, place))
        return spans, found


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> list[list[tuple[str, list[bytes]]]]:
    """Items with words, read a partition at a time and cut into blocks of at most ``BLOCK_WORDS`` words.

    One item above the bound is a block of its own.
    """
    blocks: list[list[tuple[str, list[bytes]]]] = [[]]
    held = 0
    names = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")), text_col)
    for name, text in names.toLocalIterator():
        words = folded_words(text)
        if held and held + len(words) > BLOCK_WORDS:
            blocks.append([])
            held = 0
        if words:
            blocks[-1].append((name, words))
            held += len(words)
    return blocks


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int, keep: list[str], text_col: str, item_col: str, item_text_col: str,
    finish, columns: str,
) -> DataFrame:
    """One pass over ``docs`` for each block of items.

    ``finish(kept values, words, spans, items)`` makes the row of a document or None for no row.
    """
    frame = docs.select(*keep, F.col(text_col).alias("_text")).withColumns({
        "spans": F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)"),
        "items": F.expr("cast(array() as array<string>)"),
    })
    between = ddl(frame)

    def over(frame: DataFrame, block: list, last: bool) -> DataFrame:
        def work(rows):
            automaton = ItemAutomaton(block, window)
            for *values, text, spans, items in rows:
                words = folded_words(text)
                more, names = automaton.matches(words)
                spans = merged([*((s["start"], s["stop"]) for s in spans), *more])
                items = sorted(names.union(items))
                if not last:
                    yield (*values, text, [{"start": a, "stop": b} for a, b in spans], items)
                elif (row := finish(values, words, spans, items)) is not None:
                    yield row

        return map_rows(frame, work, columns if last else between)

    blocks = item_blocks(benchmark, item_col, item_text_col)
    for block in blocks[:-1]:
        frame = staged(over(frame, block, last=False), "benchmark-block")
    return over(frame, blocks[-1], last=True)


def find_spans(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Per document: ``id_col``, ``n_words``, ``spans`` of hit words and found ``items``."""
    def finish(values, words, spans, items):
        return (*values, len(words), [{"start": a, "stop": b} for a, b in spans], items)

    return scan(
        docs, benchmark, window, [id_col], text_col, item_col, item_text_col, finish,
        f"{ddl(docs.select(id_col))}, n_words long, spans array<struct<start: long, stop: long>>, items array<string>",
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, touching ones joined, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def spans_of_words(text: str) -> list[tuple[int, int]]:
    """Code point range of every word of :func:`folded_words`."""
    return [m.span() for m in WORD.finditer(text)]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of ``spans`` and what separates them."""
    places = spans_of_words(text)
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at:places[start][0]])
        at = places[stop - 1][1]
    return "".join([*kept, text[at:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.2,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with hit spans cut from the texts, without documents hit on more than ``max_coverage`` of their words.

    Documents that are not hit keep their text exactly. ``text_col`` is the only column that changes.
    """
    named, (text,) = numbered(docs, text_col)
    at = named.columns.index(text)

    def cut(values, words, spans, _):
        if sum(b - a for a, b in spans) > max_coverage * len(words):
            return None
        if spans:
            values[at] = without_spans(values[at], spans)
        return tuple(values)

    return scan(named, benchmark, window, named.columns, text, "item_id", "text", cut, ddl(named)).toDF(*docs.columns)
