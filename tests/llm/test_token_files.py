import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import EDGE, FOLDER, documents, edge_frame, thue_morse
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidestock.llm import store, token_files
from tidestock.llm.queries import QUERIES
from tidestock.llm.store import PackedStore, string_hashes

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=500))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    segment = token_files.Segment(token_files.write_segment([5, None], [ids, ids[:3]]))
    assert [(k, at, x.tolist()) for k, at, x in segment.documents()] == [(5, 0, values), (None, len(values), values[:3])]
    for a, b in ((0, 1), (3, 200), (127, 129), (130, 400)):
        assert segment.ids(a, min(b, segment.n_ids)).tolist() == (values + values[:3])[a:b]


def test_outliers_do_not_widen_blocks():
    ids = np.arange(1280, dtype=np.uint32) % 16
    small = len(token_files.write_segment([1], [ids]))
    ids[::128] = 4_000_000_000
    assert len(token_files.write_segment([1], [ids])) <= small + 10 * 6


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sllve 09\n\t.,!é中Ⅷ²_ ́<|endoftext|>", max_size=40), max_size=6))
def test_word_ids_are_the_librarys(texts):
    texts = [*texts, "a<|endoftext|>b"]
    assert [x.tolist() for x in token_files.encoder(FILE).encode_all(texts)] == [library(t) for t in texts]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([" ", "\n", "\xa0", "\t", "\x1c", "a", "'s", "don't", ",", ".", "9", "_", "\u0301"]), max_size=9).map("".join))
def test_cuts_at_spaces(text):
    assert [x.tolist() for x in token_files.encoder(FILE).encode_all(["a", text, "b,"])] == [library(t) for t in ("a", text, "b,")]


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_polynomials_confuse(n):
    texts = list(thue_morse(n))
    assert [x.tolist() for x in token_files.encoder(FILE).encode_all(texts)] == [library(t) for t in texts]


def test_stores_are_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "MAX_STRETCHES", 20)
    own = token_files.WordEncoder(FILE)
    texts = ["many words, again many words, and many more words than the store holds"] + [f"a{i} b{i} c{i} many" for i in range(40)]
    for text in texts:
        assert own.encode_all([text])[0].tolist() == library(text)
    assert len(own.store) <= 20


def test_hashes_tell_strings_apart():
    strings = sorted({"", "a", "aa", "ab", "ba", "b", "é", "\0", "\0\0", *(f"w{i}" for i in range(5000)), *(f"{i}w" for i in range(5000))})
    for hashes in string_hashes(pa.array(strings)):
        assert len(set(hashes.tolist())) == len(strings)
    again = string_hashes(pa.array(["x", *strings]).slice(1))
    assert (again[0] == string_hashes(pa.array(strings))[0]).all()


@pytest.mark.parametrize("text", [t for _, t in EDGE] + [t for _, t in documents()])
def test_given_texts(text):
    assert token_files.encoder(FILE).encode(text or "").tolist() == library(text)
    assert token_files.encoder(FILE).encode_all([text or ""])[0].tolist() == library(text)


def test_short_strings_are_told_apart_without_a_digest(monkeypatch):
    def digest(*args, **kwargs):
        raise AssertionError("no digest for up to 15 bytes")

    monkeypatch.setattr(store.hashlib, "blake2b", digest)
    strings = ["", "\0", *("\0" * n for n in range(2, 16)), *(c * n for c in "aé" for n in range(1, 8)), "a" * 15, "\0" * 14 + "a", "a" + "\0" * 14]
    strings = sorted({*strings, *(f"same start{i}" for i in range(10_000))})
    low, high = string_hashes(pa.array(strings))
    assert len(set(zip(low.tolist(), high.tolist()))) == len(strings)
    with pytest.raises(AssertionError):
        string_hashes(pa.array(["a" * 16]))
    assert [len(x) for x in string_hashes(pa.array([], pa.string()))] == [0, 0]


def test_keys_that_share_a_half_are_found(monkeypatch):
    """Before, the second of two entries with one first half was looked for without end."""
    few = lambda strings: (h := string_hashes(strings), (h[0] % 3, h[1]))[1]
    monkeypatch.setattr(store, "string_hashes", few)
    own, asked = PackedStore(100), []

    def lists(strings):
        asked.extend(strings)
        assert len(asked) < 200
        return [[int(s)] * 2 for s in strings]

    for numbers in (range(30), range(20, 60), range(90)):
        flat, first, sizes = own.lists_of(pa.array([str(i) for i in numbers]), lists)
        assert flat[first].tolist() == flat[first + 1].tolist() == list(numbers) and set(sizes.tolist()) == {2}
    assert sorted(map(int, asked)) == list(range(90))


def check(rows, docs):
    start = 0
    rows = sorted(rows, key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys)
    left = [(i, library(t) + [2]) for i, t in docs]
    for r in rows:
        assert r.start == start
        own = next(x for x in left if x[0] == r.doc_id and zlib.crc32(np.array(x[1], "<u4").tobytes()) == r.ids_crc32)
        assert r.n_tokens == len(own[1])
        left.remove(own)
        start += r.n_tokens
    assert not left


def test_query(spark):
    check(QUERIES["op4_patched_blocks"](spark, FOLDER).collect(), documents())


def test_edges_and_empty(spark):
    digest = lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
    for frame, docs in ((edge_frame(spark), EDGE), (edge_frame(spark).limit(0), [])):
        segments = token_files.write_tokens(frame, FILE, 2)
        check(token_files.read_tokens(segments, digest, "n_tokens long, ids_crc32 long").collect(), docs)
