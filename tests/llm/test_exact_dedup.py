import hashlib
import re

import pytest
from helpers import EDGE, FOLDER, documents, edge_frame
from pyspark.sql import functions as F

from tidestock.llm import exact_dedup
from tidestock.llm.queries import QUERIES


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, fold=lowered, keep=max):
    groups = {}
    for key, text in rows:
        groups.setdefault(fold(text or ""), []).append(key)
    out = []
    for key, text in rows:
        own = groups[fold(text or "")]
        stays = keep((k for k in own if k is not None), default=None)
        out.append((key, stays, len(own), key == stays, hashlib.sha256(fold(text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_against_plain_version(spark):
    assert collected(QUERIES["op13_exact_dedup"](spark, FOLDER)) == plain(documents())


MORE = [*EDGE, (20, "ONE two THREE"), (21, "ÉA"), (22, "éa"), (23, "Éa"), (None, "x"), (None, "x"), (24, "Iİ"), (25, "iİ")]


@pytest.mark.parametrize("bits", [128, 4, 0])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_edge_cases_at_any_hash(spark, bits, keep):
    """A hash of four bits, or of none, gives the same groups: bytes decide."""
    weak = {128: exact_dedup.content_hash, 4: lambda d: F.substring(F.hex(d), 1, 1), 0: lambda d: F.lit("")}[bits]
    got = exact_dedup.exact_groups(
        edge_frame(spark, MORE), keep=keep, normalised=exact_dedup.lower_ascii, hashed=weak
    )
    assert collected(got) == plain(MORE, keep=max if keep == "largest" else min)


def test_no_python_and_no_text_joins(spark):
    plan = exact_dedup.exact_groups(edge_frame(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "body" not in plan


def test_keep_one(spark):
    frame = edge_frame(spark, MORE)
    kept = exact_dedup.keep_one(frame, normalised=exact_dedup.lower_ascii)
    assert kept.dtypes == frame.dtypes
    want = {(r[0], lowered(r[1])) for r in [*MORE] if (r[0], lowered(r[1])) in
            {(p[0], lowered(r[1])) for p in plain(MORE, keep=min) if p[3] and p[4] == hashlib.sha256(lowered(r[1]).encode()).hexdigest()}}
    got = [(r.doc_id, lowered(r.text)) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_empty_table_and_other_key_types(spark):
    empty = edge_frame(spark, []).limit(0)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0
    named = spark.createDataFrame([("b", "t"), ("a", "t"), ("c", "u")], "key string, body string")
    got = exact_dedup.exact_groups(named, "key", "body").select("key", "keep_id", "group_size", "kept")
    assert collected(got) == [("a", "a", 2, True), ("b", "a", 2, False), ("c", "c", 1, True)]
