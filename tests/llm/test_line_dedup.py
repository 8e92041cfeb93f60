import random

import numpy as np
import pytest
from helpers import EDGE, FOLDER, documents, edge_frame, thue_morse
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import line_dedup as d
from tidestock.llm.queries import QUERIES, sha256


def within_one(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs, min_chars):
    """doc_id -> (lines, removed, text); ids are unique."""
    seen, out = [], {}
    by_length = {}
    for doc_id, text in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        if text is None:
            out[doc_id] = (0, 0, None)
            continue
        left, split = [], text.split("\n")
        for line in split:
            n = len(line)
            if n < min_chars:
                left.append(line)
            elif not any(within_one(line, x) for m in (n - 1, n, n + 1) for x in by_length.get(m, ())):
                left.append(line)
            if n >= min_chars:
                by_length.setdefault(n, []).append(line)
        out[doc_id] = (len(split), len(split) - len(left), "\n".join(left))
    return out


def result(frame, min_chars):
    cut, lines, removed = d.dedup_lines(frame, min_chars)
    return {r["doc_id"]: (r[lines], r[removed], r["text"]) for r in cut.collect()}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=12), st.text(alphabet="ab", min_size=1, max_size=12))
def test_neighbours_share_a_half_and_a_variant(a, b):
    if a != b and within_one(a, b):
        assert set(d.half_keys(a)) & set(d.half_keys(b))
        assert set(d.variant_keys(a).tolist()) & set(d.variant_keys(b).tolist())


@pytest.mark.parametrize("line", ["a", "ab", "aab", "éß\U0001f600x", "abcabc"])
def test_variant_keys_stand_for_strings(line):
    keys = d.variant_keys(line).tolist()
    assert keys[0] == d.variant_keys(line)[0]
    for i, key in enumerate(keys[1:]):
        rest = line[:i] + line[i + 1:]
        if rest:
            assert key == d.variant_keys(rest)[0]


def test_long_lines_are_linear():
    assert len(np.unique(d.variant_keys("".join(map(str, range(60_000)))))) > 100_000


def test_random_small_corpora(spark):
    rng = random.Random(5)
    docs = []
    for i in range(60):
        lines = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 6))]
        docs.append((i if i else None, "\n".join(lines)))
    docs.append((1000, None))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(frame, 3) == plain(docs, 3)


def test_planted_edits(spark):
    line = "a line that is long enough to be judged by the rule"
    docs = [(5, line), (6, line.replace("long", "lung")), (7, line + "!"), (8, line[1:]), (9, line.replace("long", "tall")),
            (4, "intro\n" + line.upper()), (10, "x\n" + line + "\nshort"), (2, "clean text stays as it is, every bit")]
    got = result(spark.createDataFrame(docs, "doc_id long, text string"), 20)
    assert got == plain(docs, 20)
    assert got[6][2] == got[7][2] == got[8][2] == "" and got[9][1] == 0 and got[10][2] == "x\nshort"


def test_query(spark):
    want = plain(documents(), d.MIN_CHARS)
    for r in QUERIES["op10_deletion_neighbourhood"](spark, FOLDER).collect():
        assert (r.n_lines, r.n_removed, r.kept_sha256) == (*want[r.doc_id][:2], sha256(want[r.doc_id][2]))


def test_edges_and_empty(spark):
    frame = edge_frame(spark).withColumnRenamed("size", "kept")
    cut, *_ = d.dedup_lines(frame, 5)
    rows = cut.collect()
    assert cut.columns[:len(frame.columns)] == frame.columns and len(rows) == len(EDGE)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.text)
    assert by[1] == [None] and by[2] == [""] and by[4] == ["one two three"] and by[5] == ["", ""]
    empty, *_ = d.dedup_lines(frame.limit(0))
    assert empty.count() == 0


@pytest.mark.parametrize("n", [1024, 2048])
def test_variants_of_lines_that_polynomials_confuse(n):
    one, other = thue_morse(n)
    keys = [d.variant_keys(line) for line in (one, other, one[:100] + one[101:])]
    assert not set(keys[0].tolist()) & set(keys[1].tolist())
    assert keys[0][101] == keys[2][0]
