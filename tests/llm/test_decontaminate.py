import re

from helpers import EDGE, FOLDER, documents, edge_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import decontaminate as d
from tidestock.llm.queries import QUERIES


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        item = words(item)
        size = min(window, len(item))
        for k in range(len(item) - size + 1) if item else ():
            for i in range(len(own) - size + 1):
                if own[i:i + size] == item[k:k + size]:
                    hit.update(range(i, i + size))
                    found.add(str(name))
    return len(own), sorted(hit), sorted(found)


def check(spark, docs, items, window, monkeypatch=None):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.find_spans(frame, bench, window).collect()
    got = sorted((str(r.doc_id), r.n_words, [k for s in r.spans for k in range(s.start, s.stop)], list(r["items"])) for r in rows)
    assert got == sorted((str(i), *plain(t, items, window)) for i, t in docs)


CASES = (
    [(1, "a b c d e f g h"), (2, "b c d"), (3, None), (4, "..."), (5, "x"), (6, "a b c x"), (6, "a b c x"), (7, "a a a a a")],
    [(1, "z a B c d, e f-g h z"), (2, "a b c x b c d"), (3, "b c a a a a a a"), (4, "x y x"), (5, None), (6, ""), (7, "b c d")],
)


def test_hand_made(spark):
    check(spark, CASES[1] + EDGE[2:6], CASES[0], 4)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_WORDS", 6)
    check(spark, CASES[1], CASES[0], 4)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), min_size=1, max_size=5), st.lists(st.sampled_from("abcd"), max_size=30))
def test_automaton_against_plain_version(items, text):
    named = [(str(i), [w.encode() for w in x]) for i, x in enumerate(items) if x]
    automaton = d.ItemAutomaton(named, 4)
    spans, found = automaton.matches([w.encode() for w in text])
    want = plain(" ".join(text), [(i, " ".join(x)) for i, x in enumerate(items)], 4)
    assert [k for a, b in spans for k in range(a, b)] == want[1] and sorted(found) == want[2]


def test_query_against_plain_version(spark):
    import hashlib

    import pyarrow.parquet as pq

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    got = {r.doc_id: r for r in QUERIES["op7_decontaminate"](spark, FOLDER).collect()}
    for doc_id, text in documents():
        n, hit, found = plain(text, items)
        r = got[doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, len(hit), len(found), bool(hit))
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_cutting(spark):
    docs = spark.createDataFrame(
        [(1, "keep this part, A b c D and that part " * 3, 7), (2, "a b c d", 8), (3, "clean  text\n", 9), (4, None, 1)],
        "doc_id long, text string, spans long",
    )
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    out = {r.doc_id: r for r in d.decontaminate(docs, bench, 4, max_coverage=0.5).collect()}
    assert set(out) == {1, 3, 4} and out[3].text == "clean  text\n" and out[4].text is None and out[1].spans == 7
    assert out[1].text == "keep this part,  and that part " * 3
    empty = d.decontaminate(edge_frame(spark).limit(0), bench.limit(0))
    assert empty.count() == 0
    assert d.decontaminate(edge_frame(spark), bench.limit(0)).count() == len(EDGE)
