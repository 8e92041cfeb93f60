import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import EDGE, FOLDER, documents, edge_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidestock.llm import alignment
from tidestock.llm.queries import QUERIES

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
A.encode_special_tokens = True
ENCODER = alignment.pair_encoder(*FILES)
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in PLAIN)}


def tokens(text):
    a = [(i, bytes(BYTE[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    return a, b


def plain_groups(text):
    """Groups of whole texts, token by token."""
    if not text:
        return []
    a, b = tokens(text)
    if not b"".join(x for _, x in a) == (" " + text).encode() == b"".join(x for _, x in b):
        return []
    groups, i, j, end_a, end_b = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if j == len(b) or i < len(a) and end_a <= end_b:
            end_a += len(a[i][1])
            groups[-1][0].append(a[i][0])
            i += 1
        else:
            end_b += len(b[j][1])
            groups[-1][1].append(b[j][0])
            j += 1
        if end_a == end_b:
            groups.append(([], []))
    return groups[:-1]


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def plain(rows):
    grouped = [(key, plain_groups(text)) for key, text in rows]
    linked = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in grouped]
    counts = Counter(pair for c in linked for pair in c)
    highest = {}
    for (x, _), n in counts.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (key, groups), c in zip(grouped, linked):
        out.append((
            key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
            sum(n for (x, y), n in c.items() if counts[x, y] == highest[x]), sum(n * counts[p] for p, n in c.items()),
            hashlib.sha256(written(groups).encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_plain_version(spark):
    assert collected(QUERIES["op11_fragment_monoid"](spark, FOLDER)) == plain(documents())


MORE = [*EDGE, (30, "<|endoftext|> a<|endoftext|>"), (31, " leading  spaces \n and\t tabs \x1c x"), (32, "▁"), (33, " "), (34, "中文 " * 9_000),
        (35, "x" * 40_000 + " y " * 20_000), (36, "café " * 12_000), (37, "ends with space "), (38, "\x00\x01 \x02")]


def test_edge_cases(spark, tmp_path):
    edge_frame(spark, MORE).write.parquet(f"{tmp_path}/documents.parquet")
    assert collected(QUERIES["op11_fragment_monoid"](spark, str(tmp_path))) == plain(MORE)
    edge_frame(spark, MORE).limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert QUERIES["op11_fragment_monoid"](spark, f"{tmp_path}/empty").count() == 0


def test_groups_of_all_texts(spark):
    got = alignment.align(edge_frame(spark, MORE), *FILES)
    assert got.columns == ["doc_id", "ok", "a", "b", "a_sizes", "b_sizes"]
    out = []
    for r in got.collect():
        a, b = iter(r.a), iter(r.b)
        out.append((r.doc_id, [([next(a) for _ in range(n)], [next(b) for _ in range(m)]) for n, m in zip(r.a_sizes, r.b_sizes)]))
    assert sorted(out, key=repr) == sorted(((k, plain_groups(t)) for k, t in MORE), key=repr)


LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet=LETTERS, min_size=1, max_size=12), st.text(alphabet="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~×÷ªº²9", max_size=3)), min_size=1, max_size=8))
def test_words_with_stops_are_the_librarys(words):
    stretches = [f" {word}{stops}" for word, stops in words] + [" don't", " 's", " <|endoftext|>", " |>", "  x", " ", " a1", " a.b", " ."]
    assert ENCODER.a_ids(stretches) == [e.ids for e in A.encode_batch(stretches, add_special_tokens=False)]


def test_most_stretches_need_the_merges_only(monkeypatch):
    seen = []

    class Library:
        def encode_batch(self, texts, **kwargs):
            seen.extend(texts)
            return A.encode_batch(texts, **kwargs)

    monkeypatch.setattr(ENCODER, "a", Library())
    monkeypatch.setattr(alignment, "MAX_STOPS", 2)
    stretches = [*(f" {c}" for c in LETTERS if c not in "ªµº"), " word.", " été,", " Straße!?", " x##", " a\nb", " it's", " 42"]
    assert ENCODER.a_ids(stretches) == [e.ids for e in A.encode_batch(stretches, add_special_tokens=False)]
    assert seen == [" a\nb", " it's", " 42"]


def whole(text):
    found = alignment.fragments_of(ENCODER, [" " + text], np.array([0]), np.array([len((" " + text).encode())]))
    return found.closed().written(ENCODER)[0].decode()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="etaoin stheE \n\t▁é0.,中\U0001f600\x00\x1c\xa0'", min_size=1, max_size=50))
def test_any_text(text):
    assert whole(text) == written(plain_groups(text))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="etaoin stheE \né中\U0001f600", min_size=30, max_size=120), st.integers(1, 40), st.data())
def test_ranges_compose_in_any_grouping(text, size, data):
    """Fragments of byte ranges, which may fall into characters and tokens, give the groups of the whole text."""
    before = alignment.CHUNK
    alignment.CHUNK = size
    try:
        ranges = list(alignment.byte_ranges(" " + text))
    finally:
        alignment.CHUNK = before
    assert sum(high - low for _, low, high in ranges) == len((" " + text).encode())
    parts = [alignment.fragments_of(ENCODER, [w], np.array([a]), np.array([b])) for w, a, b in ranges]

    def compose(some):
        return alignment.Fragments.of([pa_concat([f.arrays()[k] for f in some]) for k in range(5)]).composed()

    while len(parts) > 1:
        k = data.draw(st.integers(0, len(parts) - 2))
        parts[k:k + 2] = [compose(parts[k:k + 2])]
    assert parts[0].closed().written(ENCODER)[0].decode() == written(plain_groups(text))


def pa_concat(arrays):
    import pyarrow as pa

    return pa.concat_arrays(arrays)


def test_long_groups_are_counted_by_distinct_ids(monkeypatch):
    def links():
        text, pair, count = alignment.fragments_of(ENCODER, [" 中国人民 hello \U0001f600\U0001f601"], np.array([0]), np.array([99])).closed().links()
        out = Counter()
        for p, n in zip(pair.tolist(), count.tolist()):
            out[p] += n
        return out

    want = links()
    monkeypatch.setattr(alignment, "DIRECT", 1)
    assert links() == want


@pytest.mark.parametrize("number", [0, 255, 256, 70_000, 1 << 40])
def test_packed_numbers(number):
    assert alignment.unpacked(alignment.packed(np.array([1, number, 0]))).tolist() == [1, number, 0]


def test_last_step_holds_one_block_at_a_time(spark, monkeypatch):
    """Blocks that fall into one partition don't share a batch, and no list of a block's pairs is collected."""
    monkeypatch.setattr(alignment, "BLOCK", 1)
    rows = [(k, f"one two three {k} words, and some more") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    blocks = alignment.link_blocks(docs, *FILES, lambda found, own: [(int(n),) for n in found.n_a], "n_a long")
    out = alignment.document_links(blocks, "n_a long")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    found = {r["key"]: (r["n_links"], r["n_best"], r["count_sum"]) for r in out.collect()}
    assert found == {r[0]: r[4:7] for r in plain(rows)}


def test_fragments_of_long_texts_travel_as_bytes(spark):
    """Between the steps a text's fragments take at most half of what four lists of integers would."""
    texts = spark.createDataFrame([(1, "some words of a long text, é 中 " * 3_000), (2, "x" * 40_000)], "key long, text string")
    row = alignment.long_texts(texts, FILES)
    assert dict(row.dtypes)["a"] == "binary"
    for r in row.collect():
        lists = [alignment.unpacked(v) for v in (r.a, r.b, r.a_sizes, r.b_sizes)]
        assert sum(map(len, (r.a, r.b, r.a_sizes, r.b_sizes))) < 2 * sum(map(len, lists))
