import re
from collections import Counter
from math import comb

import pytest
from helpers import EDGE, FOLDER, documents, edge_frame

from tidestock.llm import quality_rules as q
from tidestock.llm.queries import QUERIES


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 2000 else None
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside), n < 10 or 100 * len(inside) > 20 * n


@pytest.mark.parametrize("text", [t for _, t in EDGE] + [t for _, t in documents()[:100]] + ["a b c d e f a b c d e a b c d e\na\na"])
def test_counts(text):
    got = q.measured(text)
    assert (*got[:5], got[7]) == plain(text)


def test_binomial_tail_is_exact():
    for n, p in ((1, 0.3), (7, 0.1), (40, 0.05)):
        for x in range(n + 1):
            want = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1))
            assert q.binomial_tail(x, n, p) == pytest.approx(want, abs=1e-12)


def test_cutoffs_keep_their_promise():
    good, bad = [0] * 101, [0] * 101
    good[0], good[30], bad[30], bad[80] = 300, 40, 20, 50
    assert q.certified(good, bad, 0.10, 0.01) == 80  # 40 of 340 good rejected is above one tenth
    assert q.certified(good, [0] * 101, 0.10, 0.01) is None
    good[0] = 20
    assert q.certified(good, bad, 0.10, 0.01) is not None
    assert q.certified([10] + [0] * 100, bad, 0.10, 0.01) is None  # too few labels


def test_query_against_plain_version(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op3_quality_rules"](spark, FOLDER).collect()}
    for doc_id, text in documents():
        r = rows[doc_id]
        want = plain(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_rules_that_hit_different_good_documents_stay_within_the_limit_together(spark):
    good = [(i, [50 if i < 126 and i % 3 == k else 0 for k in range(3)]) for i in range(600)]  # 7 % by each rule
    bad = [(1000 + i, [40] * 3) for i in range(100)]
    measures = spark.createDataFrame(
        [(i, "en", False, *severities) for i, severities in good + bad],
        "doc_id long, stratum string, base_failed boolean, symbols int, shouting int, repetition int",
    )
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id long, quality int")
    judged = q.judge(measures, q.choose_cutoffs(measures, labels))
    assert judged.where("doc_id < 1000 and not kept").count() <= 60
    apart = measures.replace(50, 0, ["shouting", "repetition"]).replace(50, 30, ["symbols"])
    assert q.judge(apart, q.choose_cutoffs(apart, labels)).where("not kept").count() == 100


def junk(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda".split()
    rows, labels = [], []
    for i in range(400):
        bad = i % 10 == 0
        text = " ".join(w + ("###" if bad else "") for w in words) + f" tail{i}"
        rows.append((i, text, "en" if i % 2 else None))
        labels += [(i, 0 if bad else 1)] * (1 + (i == 3)) + [(10_000 + i, 1), (i, None)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def test_junk_goes_and_good_stays(spark):
    docs, labels = junk(spark)
    kept = {r.doc_id for r in q.keep_good(docs, labels).collect()}
    assert kept == {i for i in range(400) if i % 10}


def test_edges_and_empty(spark):
    docs, labels = junk(spark)
    frame = edge_frame(spark).withColumnRenamed("n_words", "kept")
    out = q.keep_good(frame, labels)
    assert out.columns == frame.columns and out.count() == 0  # all are short or repetitive
    assert q.keep_good(frame.limit(0), labels.limit(0)).count() == 0
    assert q.measure(frame).count() == len(EDGE)
