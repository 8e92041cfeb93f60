from collections import defaultdict
from zlib import crc32

from helpers import FOLDER, documents, edge_frame

from tidestock.llm import sharding
from tidestock.llm.queries import QUERIES


def laid_out(rows, key, size, shards):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append((r["slot"], -(1 << 63) if r[key] is None else r[key], r[size]))
    assert set(by) <= set(range(shards))
    last = None
    for shard in sorted(by):
        held = sorted(by[shard])
        assert [slot for slot, _, _ in held] == list(range(len(held)))
        keys = [k for _, k, _ in held]
        assert keys == sorted(keys) and (last is None or last <= keys[0])
        last = keys[-1]
    return {shard: sum(s for _, _, s in held) for shard, held in by.items()}


def test_query(spark):
    rows = QUERIES["op9_sampled_splitters"](spark, FOLDER).collect()
    want = {i: (len(t.encode()) + 1, crc32(t.encode())) for i, t in documents()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want
    sums = laid_out(rows, "doc_id", "size", 8)
    mean = sum(sums.values()) / 8
    assert len(sums) == 8 and max(abs(s - mean) for s in sums.values()) <= max(s for s, _ in want.values())


def test_sizes_are_near_equal_though_one_key_holds_a_third(spark):
    frame = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 777, id) as doc_id", "cast(1 + pow(id % 97, 2) as long) as size", "id as shard0", "1 as _first0"
    )
    rows = sharding.range_shards(frame, "doc_id", "size", 8).collect()
    assert len(rows) == 60_000
    sums = laid_out(rows, "doc_id", "size", 8)
    mean = sum(sums.values()) / 8
    assert len(sums) == 8 and all(abs(s - mean) < 0.01 * mean for s in sums.values())


def test_few_null_and_no_records(spark):
    frame = edge_frame(spark).selectExpr("doc_id", "text", "size", "n_words")
    rows = sharding.range_shards(frame, "doc_id", "size", 8).collect()
    laid_out(rows, "doc_id", "size", 8)
    assert len(rows) == frame.count()
    assert sharding.range_shards(frame.limit(0), "doc_id", "size", 8).count() == 0


def test_dealing():
    assert sharding.dealt([(5, 2), (5, 3), (5, 1), (5, 1)], 2) == [(0, 0), (0, 2), (1, 0), (1, 1)]
    assert sharding.dealt([], 8) == []
