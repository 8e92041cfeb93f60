import random
import re

import numpy as np
import pytest
from helpers import EDGE, documents, edge_frame

from tidestock.llm import chosen_path as c
from tidestock.llm.components import components
from tidestock.llm.queries import QUERIES


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else None


def plain(docs, similarity=0.8):
    """doc_id -> (class id, links, n-grams) by comparing all distinct sets that share an n-gram."""
    sets = {}
    for doc_id, text in docs:
        g = grams(text)
        if g:
            sets.setdefault(g, []).append(doc_id)
    every = list(sets)
    at = {}
    for k, g in enumerate(every):
        for x in g:
            at.setdefault(x, set()).add(k)
    links = {k: set() for k in range(len(every))}
    for k, g in enumerate(every):
        for other in set().union(*(at[x] for x in g)) - {k}:
            both = len(g & every[other])
            if both >= similarity * (len(g) + len(every[other]) - both):
                links[k].add(other)
    out, seen = {}, set()
    for k in links:
        if k in seen:
            continue
        todo, group = [k], {k}
        while todo:
            for other in links[todo.pop()] - group:
                group.add(other)
                todo.append(other)
        seen |= group
        least = min(d for x in group for d in sets[every[x]])
        for x in group:
            out |= {d: (least, len(links[x]), len(every[x])) for d in sets[every[x]]}
    return out | {d: (d, 0, 0) for d, t in docs if not grams(t)}


def variants(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("text", [t for _, t in EDGE] + ["a", "a b c d e", "a b c d e f f f f f f"])
def test_sets_stand_for_ngrams(text):
    assert len(c.ngram_set(text)) == len(grams(text) or ())


def test_runs_reach_the_recall():
    lost = 0.0625  # solves q = (0.2 + 0.8 q)^2
    assert c.runs_for(0.8, 0.999) == 3 and lost**3 < 0.001 < lost**2
    assert c.runs_for(0.8, 0.9) == 1


def test_comparison_is_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(80)]
    want = [[len(np.intersect1d(a, b)) >= 0.5 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (c.linked(sets, sets, 0.5) == np.array(want)).all()
    assert (c.linked(sets[:30], sets[30:], 0.5) == np.array(want)[:30, 30:]).all()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in {y for e in edges if e[0] != e[1] for y in e}}


def near_copies():
    rng = random.Random(7)
    docs, doc_id = [], 0
    for group in range(12):
        words = [f"g{group}w{k}" for k in range(rng.randint(60, 120))]
        for edits in [0, 0, *[rng.randint(1, 4) for _ in range(rng.choice([1, 3, 40]))]]:
            docs.append((doc_id := doc_id + 1, variants(rng, words, edits)))
    docs += [(doc_id + k, "shared opening line of five and more words " + variants(rng, "abcdefghij" * 5, 45)) for k in range(1, 40)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("leaf, block", [(1000, 500), (8, 5)])
def test_planted_copies(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(c, "LEAF", leaf)
    monkeypatch.setattr(c, "BLOCK", block)
    docs = near_copies()
    rows = c.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), recall=0.999999).collect()
    assert {r.key: (r.class_key, r.links, r["size"]) for r in rows} == plain(docs)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    want = plain(documents(folder))
    got = {r.doc_id: (r.class_id, r.n_links, r.n_shingles) for r in QUERIES["op8_chosen_path"](spark, folder).collect()}
    assert set(got) == set(want)
    links, found = sum(w[1] for w in want.values()), sum(g[1] for g in got.values())
    assert found >= 0.99 * links and all(got[d][1] <= want[d][1] for d in want)
    assert sum(got[d] == want[d] for d in want) >= 0.99 * len(want)


def test_one_of_each_class_stays(spark):
    docs = near_copies()
    frame = spark.createDataFrame([(*d, 3) for d in docs + docs[:5] + [(900, None), (901, " ")]], "doc_id long, text string, size int")
    kept = c.keep_one(frame).collect()
    assert sorted(r.doc_id for r in kept) == sorted({w[0] for w in plain(docs).values()}) + [900, 901]
    assert all((r.doc_id, r.text) in docs or r.doc_id >= 900 for r in kept)


def test_edges_and_empty(spark):
    rows = c.near_duplicates(edge_frame(spark)).collect()
    by = {(r.key, r.links): r for r in rows}
    assert len(rows) == len(EDGE) and by[5, 0].class_key == 4 and by[1, 0].class_key == 1
    assert c.near_duplicates(edge_frame(spark).limit(0)).count() == 0
    assert c.keep_one(edge_frame(spark).limit(0)).count() == 0
