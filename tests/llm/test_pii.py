import re

import numpy as np
import pytest
from helpers import EDGE, FOLDER, documents, edge_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import pii
from tidestock.llm.queries import QUERIES, sha256


def plain(text):
    text = text or ""
    out = {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
               if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [], "phone": [],
    }
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        ds = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(ds)))
        if 13 <= len(ds) <= 19 and total % 10 == 0:
            out["card"].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out["phone"].append(m.span())
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="a1.@-+ (0%4Ⅷ٣", max_size=40))
def test_base_patterns(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", [t for _, t in EDGE] + ["4111 1111-1111 1111, +1 (017) 555-7713. x@y.z@w.v 1.2.3.4.5.6.7.8"])
def test_base_patterns_on_cases(text):
    assert pii.base_spans(text or "") == plain(text)


def test_long_runs_are_linear():
    for run in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1(" * 100_000):
        pii.base_spans(run)
        pii.proposals(run)


def test_long_values_are_proposed_whole():
    key, late = "a1B2c3D4" * 50, "abcdefgh" * 10 + "7" + "ijklmnop" * 30
    found = lambda text: {(k, p, text[a:b]) for k, p, a, b in pii.proposals(text)}
    assert {("secret", 3, key), ("secret", 4, key)} <= found(f"my api_key = {key} and more")
    assert ("secret", 4, late) in found(f"bearer {late} and more")
    assert found("letters only " + "abcdefgh" * 50) == set()
    for address in ("b" * 80 + " [at] mail [dot] example.org", "joe (at) " + "c" * 70 + ".a.b.c.d.e.example.com"):
        assert ("email", 1, address) in found(f"write to {address}, please")
    text = f"my api_key = {key}"
    assert pii.votes_of(text, "secret", 13, 413, False)[-1] == 1


def test_long_runs_of_wider_patterns_are_linear():
    for run in ("a" * 300_000, "token=" * 50_000, "a[at]" * 60_000, "a[at]" + "a." * 150_000, "a-" * 150_000, "ab1" * 100_000):
        pii.proposals(run + " (at) token: ")


def test_long_secrets_are_added_whole(spark):
    key = lambda i, n: "g".join(sha256(f"{i}-{k // 8}")[k % 8 * 4:][:4] for k in range(8 * n))
    rows = [(i, f"some words here token = {key(i, 1 if i < 40 else 12)} more words") for i in range(60)]
    out = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        assert [(s.kind, text[s.start:s.stop]) for s in out[i]] == [("secret", text[24:-11])]


def test_em_separates_reliable_from_unreliable_votes():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.3
    flip = lambda rate: np.where(rng.random(4000) < rate, ~truth, truth) * 2 - 1
    votes = np.stack([flip(0.05), flip(0.1), flip(0.15), flip(0.5)], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = pii.estimate(patterns, counts.astype(float))
    assert np.mean((posterior[inverse.ravel()] > 0.5) == truth) > 0.95


def test_secrets_are_added_and_prose_is_left_alone(spark):
    rows = [(i, f"some words here token = \"{i:04x}bebab91ab85687d33eeaaf9ac699e118{i:04x}\" more words") for i in range(40)]
    rows += [(100 + i, "plain words only, nothing personal, well-known-hyphenated-compounds-of-words") for i in range(40)]
    out = {r.doc_id: r.spans for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(40):
        assert [(s.kind, rows[i][1][s.start:s.stop]) for s in out[i]] == [("secret", f"{i:04x}bebab91ab85687d33eeaaf9ac699e118{i:04x}")]
        assert out[100 + i] == []


def test_query_against_plain_version(spark):
    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, FOLDER).collect()}
    for doc_id, text in documents():
        want, r = plain(text), got[doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.BASE_KINDS]
        base = ",".join(f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in want[k])
        assert r.base_sha256 == sha256(base)
        assert set(base.split(",")) - {""} <= set(r.spans.split(","))


def test_edges_and_empty(spark):
    assert pii.find_pii(edge_frame(spark)).count() == len(EDGE)
    assert pii.find_pii(edge_frame(spark).limit(0)).count() == 0
