import public_tokenizers
import pytest
import sentencepiece
from helpers import EDGE, FOLDER, documents, edge_frame, thue_morse
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import piece_codec
from tidestock.llm.queries import QUERIES, sha256

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = piece_codec.codec(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(text):
    ids = CODEC.encode(text)
    assert ids == LIBRARY.encode(text or "")
    assert CODEC.as_decimal(ids) == ",".join(map(str, ids))
    assert [x.tolist() for x in CODEC.encode_all(["a", text or "", "b."])] == [LIBRARY.encode(t) for t in ("a", text or "", "b.")]


@pytest.mark.parametrize("text", [t for _, t in EDGE] + [t for _, t in documents()])
def test_given_texts(text):
    same(text)


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="etaoinshr ETHN \n\t▁éß0.,中\U0001f600", max_size=60))
def test_mixed_texts(text):
    same(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=40))
def test_any_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([LIBRARY.id_to_piece(i) for i in range(259, 32000, 37)]), max_size=8))
def test_pieces_in_a_row(pieces):
    same("".join(pieces).replace("▁", " "))


@pytest.mark.parametrize("text", ["x" * 30_000, " " * 5_000, "\n" * 3_000, "ab" * 20_000, "internationalization" * 500])
def test_long_runs(text):
    same(text)


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_polynomials_confuse(n):
    texts = list(thue_morse(n))
    assert [x.tolist() for x in CODEC.encode_all(texts)] == [LIBRARY.encode(t) for t in texts]


def test_stores_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_codec, "MAX_PARTS", 20)
    monkeypatch.setattr(piece_codec, "MAX_PAIRS", 3)
    own = piece_codec.PieceCodec(MODEL)
    text = "many different words make the small stores overflow, again and again and many times"
    for part in (text, "quite other words", text[::-1], text):
        assert own.encode_all([part])[0].tolist() == LIBRARY.encode(part)
    assert len(own.parts) <= 20 and len(own.pairs) <= 6


def test_query(spark):
    got = {r.doc_id: r for r in QUERIES["op5_prefix_table"](spark, FOLDER).collect()}
    for doc_id, text in documents():
        ids = LIBRARY.encode(text)
        r = got[doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(",".join(map(str, ids)))
        assert r.decoded_sha256 == sha256(LIBRARY.decode(ids))


def test_edges_and_empty(spark):
    rows = piece_codec.encode(edge_frame(spark), MODEL).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), LIBRARY.encode(t or "")) for i, t in EDGE)
    assert piece_codec.encode(edge_frame(spark).limit(0), MODEL).count() == 0
