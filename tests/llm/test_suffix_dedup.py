import random

import numpy as np
import pytest
from helpers import EDGE, documents, edge_frame

from tidestock.llm import induced
from tidestock.llm import suffix_dedup as d
from tidestock.llm.queries import QUERIES, sha256

COLUMNS = "n_bytes long, n_removed long, n_spans long, kept binary"


def plain(docs):
    """(doc_id, text) -> bytes, removed, spans, kept: every 50-byte string by the least id it starts in."""
    number = lambda i: d.LOWEST if i is None else i
    least = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            window = data[p:p + 50]
            least[window] = min(least.get(window, 1 << 62), number(doc_id))
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 49):
            if least[data[p:p + 50]] < number(doc_id):
                gone[p:p + 50] = True
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        out.append((number(doc_id), len(data), int(gone.sum()), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out)


def result(frame):
    digest = lambda data, a, b: (len(data), int((b - a).sum()), len(a), d.kept_bytes(data, a, b))
    rows = d.repeated_spans(frame, digest, COLUMNS).collect()
    return sorted((r.key, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows)


def corpus():
    rng = random.Random(11)
    words = ["alpha", "be", "gamma ray", "delta", "é", "\n", "zz", "the of and to"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, other = text(30), text(60)
    docs = [(k, text(rng.randint(0, 60))) for k in range(100, 130)]
    docs += [(k, text(10) + passage + text(10)) for k in (5, 9, 200)] + [(7, passage[:60]), (6, passage[:50]), (4, passage[:49])]
    docs += [(k, other) for k in (300, 20, 301)] + [(302, other[:80] + "X" + other[81:])]
    docs += [(400, "ab" * 100), (401, "ab" * 40), (402, "a" * 300), (403, "a" * 60 + "b" + "a" * 55), (404, "x" * 49)]
    docs += [(None, other[30:120]), (500, None), (501, ""), (300, other), (300, "again " + other)]
    rng.shuffle(docs)
    return docs


def test_planted_repeats(spark):
    docs = corpus()
    assert result(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)


def test_in_small_parts(spark, monkeypatch):
    docs = corpus()
    monkeypatch.setattr(d, "SHARD_BYTES", 600)
    pairing = d.Pairing

    want = plain(docs)
    assert result(spark.createDataFrame(docs, "doc_id long, text string").repartition(7)) == want
    assert pairing is d.Pairing


def rows_of(docs):
    out = []
    for doc_id, text in docs:
        data = np.frombuffer(text.encode(), np.uint8)
        for picked, whole, first, n in d.fragments(data, np.array([len(data)])):
            for row in zip((picked >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist(), whole.view(np.int64).tolist(), first.tolist(), n.tolist()):
                out.append((row[0], row[1], doc_id, row[2], row[3]))
    return sorted(out, key=lambda r: (r[0], r[1], r[4], r[2], r[3]))


@pytest.mark.parametrize("waiting", [1 << 20, 2])
@pytest.mark.parametrize("size", [3, 50])
def test_pairing_does_not_depend_on_batches(monkeypatch, waiting, size):
    monkeypatch.setattr(d, "WAITING", waiting)
    docs = [(k, t) for k, t in corpus() if k and t]
    rows = rows_of(docs)

    def run(step):
        pairing, waits, out = d.Pairing(), None, []
        for at in range(0, len(rows), step):
            columns = [np.array(c) for c in zip(*rows[at:at + step])]
            if waits is not None:
                columns = [np.concatenate(p) for p in zip(waits, columns)]
            got, waits = pairing(columns, last=False)
            out += zip(*(x.tolist() for x in got)) if got else []
        got, _ = pairing(waits, last=True)
        return out + (list(zip(*(x.tolist() for x in got))) if got else [])

    whole, parts = run(len(rows)), run(size)
    assert {x for x in parts if x[0]} == {x for x in whole if x[0]}
    assert set(whole) <= set(parts)


def test_equal_windows_meet_in_one_picked_hash():
    rng = random.Random(1)
    text = "".join(rng.choice("ab ") for _ in range(600))
    seen = {}
    for doc in (text, "zzz" + text[100:400], text[250:]):
        data = np.frombuffer(doc.encode(), np.uint8)
        covered = 0
        for picked, _, first, n in d.fragments(data, np.array([len(data)])):
            for p, a, k in zip(picked.tolist(), first.tolist(), n.tolist()):
                covered += k
                for w in range(a, a + k):
                    assert seen.setdefault(doc[w:w + 50], p) == p
        assert covered == len(doc) - 49


def test_pieces_and_many_documents(monkeypatch):
    docs = [t.encode() for _, t in documents()[:40]] + [b"", b"short"]
    data, ends = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([len(x) for x in docs])
    windows = lambda: sorted(w for _, _, a, n in d.fragments(data, ends) for s, k in zip(a.tolist(), n.tolist()) for w in range(s, s + k))
    want = [p for end, doc in zip(ends.tolist(), docs) for p in range(end - len(doc), end - 49)]
    assert windows() == want
    monkeypatch.setattr(d, "PIECE", 1000)
    assert windows() == want


def test_shard_far_larger_than_memory(monkeypatch):
    rng = random.Random(9)
    bodies = [bytes(rng.choice(b"abc ") for _ in range(rng.randint(50, 90))) for _ in range(300)]
    bodies += [b[5:] + b"tail" for b in bodies[:60]]
    keys = np.array([rng.randrange(40) for _ in bodies])
    want = d.repeated_windows(bodies, keys)
    assert want.any()
    monkeypatch.setattr(induced, "MEMORY", 500)
    assert (d.repeated_windows(bodies, keys) == want).all()


def hot_corpus():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    docs = [(k, text(60) + "https://www.example.org/about/terms?id=" + text(60)) for k in range(150)]
    docs += [(k, text(60) + "All rights reserved by the holders of this collection, see the license file." + text(60)) for k in range(150, 300)]
    return docs + [(300, docs[7][1][20:]), (301, docs[200][1][:150])]


def test_hot_picked_hash_is_split_below_a_shard(spark, monkeypatch):
    docs = hot_corpus()
    monkeypatch.setattr(d, "SHARD_BYTES", 2500)
    frame = spark.createDataFrame(docs, "key long, text string").selectExpr("key", "shiftrightunsigned(xxhash64(text), 33) version", "text")
    largest = lambda rows: rows.selectExpr("picked", "n + 50 size").groupBy("picked").sum("size").agg({"sum(size)": "max"}).first()[0]
    wanted = d.pair_fragments(d.cut_fragments(frame)).where("not repeat").drop("repeat")
    split, repeats = d.split_hot(frame, wanted)
    assert largest(wanted) > d.SHARD_BYTES >= largest(split)
    assert repeats
    assert result(frame.selectExpr("key doc_id", "text")) == plain(docs)


@pytest.mark.parametrize("level", range(1, d.LEVELS + 1))
def test_equal_windows_meet_in_one_part(level):
    seen = {}
    for _, text in hot_corpus():
        data = text.encode()
        for _, _, first, n in d.fragments(np.frombuffer(data, np.uint8), np.array([len(data)])):
            for a, k in zip(first.tolist(), n.tolist()):
                parts = d.parts_of(data[a:a + k + 49], level)
                assert [w for _, _, b, m in parts for w in range(b, b + m)] == list(range(k))
                for picked, _, b, m in parts:
                    for w in range(a + b, a + b + m):
                        assert seen.setdefault(data[w:w + 50], picked) == picked
                if level == d.LEVELS:
                    assert {m for *_, m in parts} == {1}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op2_induced_suffixes"](spark, folder).collect()
    want = [(i, n, r, s, sha256(kept)) for i, n, r, s, kept in plain(documents(folder))]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want


def test_edges_and_empty(spark):
    assert result(edge_frame(spark)) == plain(EDGE)
    assert result(edge_frame(spark).limit(0)) == []
