import random

import duckdb
import pytest
from helpers import FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import chat_trees as c
from tidestock.llm.queries import ORACLES, PLANTED_TURN, QUERIES, sha256

SCHEMA = "tree long, node long, parent long, role string, text string, score double"
TRICKY = st.text(alphabet="<|\\im_endstar>\n a", max_size=30)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), TRICKY), TRICKY), max_size=6))
def test_round_trip(turns):
    formatted, spans = c.format_turns(turns)
    assert c.read_turns(formatted) == turns
    assert c.read_loss(formatted, spans) == "".join(t for r, t in turns if r == "assistant")
    assert formatted.count("<|") == 2 * len(turns)


def plain(rows, branches):
    """tree -> chosen paths as lists of (role, text), by walking up from every leaf."""
    by = {(t, n): (p, r, x, s) for t, n, p, r, x, s in rows}
    out = {}
    for tree in {r[0] for r in rows}:
        parents = {p for (t, _), (p, *_) in by.items() if t == tree}
        paths = []
        for t, leaf in by:
            if t == tree and leaf not in parents:
                total, path, at = 0.0, [], leaf
                while (tree, at) in by:
                    at_parent, role, text, score = by[tree, at]
                    total += score or 0.0
                    path.append((role or "", text or ""))
                    at = at_parent
                paths.append((-total, leaf, path[::-1]))
        out[tree] = [p for *_, p in sorted(paths)[:branches]]
    return out


@pytest.mark.parametrize("branches", [1, 3, None])
def test_trees_against_walking(spark, branches):
    rng = random.Random(4)
    rows = []
    for tree in range(25):
        for node in range(rng.choice([1, 5, 30])):
            parent = rng.choice([None, 777, *range(node)]) if rng.random() < 0.3 else (node - 1 if node else None)
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None]), rng.choice([None, "", f"text {node}"]), rng.choice([1.0, 2.0, None])))
    got = {}
    for r in c.format_trees(spark.createDataFrame(rows, SCHEMA), branches).orderBy("tree", "score", "leaf").collect():
        got.setdefault(r.tree, []).append(c.read_turns(r.formatted))
    want = plain(rows, branches)
    assert {t: sorted(p) for t, p in got.items()} == {t: sorted(p) for t, p in want.items()}


def test_long_chains_take_few_joins(spark):
    rows = [(1, n, n - 1 if n else None, "user", str(n), 1.0) for n in range(700)]
    (row,) = c.format_trees(spark.createDataFrame(rows, SCHEMA)).collect()
    assert c.read_turns(row.formatted) == [("user", str(n)) for n in range(700)] and row.score == 700


def test_cycles_are_refused(spark):
    rows = [(1, 1, 2, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0)]
    with pytest.raises(ValueError, match="cycle"):
        c.format_trees(spark.createDataFrame(rows, SCHEMA))


def test_null_trees_and_repeated_rows(spark):
    chain = [("a", None), ("b", 1), ("c", 2), ("d", 3)]
    for tree in (None, 4):
        rows = [(tree, n, parent, "user", text, 1.0) for n, (text, parent) in enumerate(chain, 1)]
        (row,) = c.format_trees(spark.createDataFrame([*rows, rows[2], rows[2], rows[0]], SCHEMA).repartition(5)).collect()
        assert row.tree == tree and row.score == 4.0
        assert c.read_turns(row.formatted) == [("user", text) for text, _ in chain]


@pytest.mark.parametrize("other", [(1, 2, 1, "user", "else", 1.0), (1, 2, 1, "user", "b", 2.0), (1, None, 1, "user", "b", 1.0)])
def test_two_messages_with_one_id_are_refused(spark, other):
    rows = [(1, 1, None, "user", "a", 1.0), (1, 2, 1, "user", "b", 1.0), other]
    with pytest.raises(ValueError, match="unique"):
        c.format_trees(spark.createDataFrame(rows, SCHEMA))


def test_edges_and_empty(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None, 1), (1, 0, "user", None, 1), (1, None, None, "first", 1), (None, 3, "assistant", "lost", 2), (2, 1, "assistant", "x" * 500_000, 1)],
        "conv_id long, turn long, role string, text string, node int",
    )
    got = {r.tree: c.read_turns(r.formatted) for r in c.format_trees(c.conversations_as_trees(turns)).collect()}
    assert got == {1: [("", "first"), ("user", ""), ("user", "")], None: [("assistant", "lost")], 2: [("assistant", "x" * 500_000)]}
    assert c.format_trees(c.conversations_as_trees(turns.limit(0))).count() == 0


def test_query_against_sql(spark):
    rows = QUERIES["op1_reply_trees"](spark, FOLDER).collect()
    duck = duckdb.connect()
    duck.execute(f"create view conversations as from '{FOLDER}/conversations.parquet'")
    result = duck.execute(ORACLES["op1_reply_trees"])
    names = [d[0] for d in result.description]
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(result.fetchall())
    planted = next(r for r in rows if r.conv_id == -1)
    assert planted.n_turns == 2 and planted.loss_chars == len(PLANTED_TURN) and planted.loss_sha256 == sha256(PLANTED_TURN)
