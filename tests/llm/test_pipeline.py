import importlib.util
import inspect
import re
import sys
from pathlib import Path

import pyarrow.parquet as pq
import test_chosen_path
import test_decontaminate
import test_line_dedup
import test_quality_rules
from test_piece_codec import LIBRARY

from tidestock.llm import quality_rules
from tidestock.llm.queries import sha256

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


def rows(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def plain_quality(docs, labels):
    good = {}
    for r in labels:
        good[r["doc_id"]] = max(good.get(r["doc_id"], 0), r["quality"])
    measured = {d["doc_id"]: (d["lang"], quality_rules.measured(d["text"])) for d in docs}
    counts = {}
    for doc_id, quality in good.items():
        lang, m = measured[doc_id]
        if not m[7]:
            for rule, severity in zip(quality_rules.RULES, m[8:]):
                counts.setdefault((lang, rule), ([0] * 101, [0] * 101))[1 - quality][severity] += 1
    law = inspect.signature(quality_rules.choose_cutoffs).parameters
    limit, error = law["limit"].default / len(quality_rules.RULES), law["error"].default / len(counts)
    cutoffs = {k: quality_rules.certified(*v, limit, error) or 999 for k, v in counts.items()}
    fine = lambda lang, m: not m[7] and all(s < cutoffs.get((lang, r), 999) for r, s in zip(quality_rules.RULES, m[8:]))
    return [d for d in docs if fine(*measured[d["doc_id"]])]


def plain_spans(docs, items):
    out = []
    for d in docs:
        n, hit, _ = test_decontaminate.plain(d["text"], items)
        if len(hit) > 0.2 * n:
            continue
        text = d["text"]
        if hit:
            places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
            gone = set()
            for k in hit:
                gone.update(range(*places[k]))
                if k + 1 in set(hit):
                    gone.update(range(places[k][1], places[k + 1][0]))
            text = "".join(c for k, c in enumerate(text) if k not in gone)
        out.append(d | {"text": text})
    return out


def test_run_against_plain_version(spark):
    docs = plain_quality(rows("documents"), rows("labels"))
    cut = test_line_dedup.plain([(d["doc_id"], d["text"]) for d in docs], 20)
    docs = [d | {"text": cut[d["doc_id"]][2]} for d in docs if not cut[d["doc_id"]][1] or cut[d["doc_id"]][2].strip(" \t\n\r\x0b\x0c")]
    classes = test_chosen_path.plain([(d["doc_id"], d["text"]) for d in docs])
    docs = [d for d in docs if classes[d["doc_id"]][0] == d["doc_id"]]
    docs = plain_spans(docs, [(r["item_id"], r["text"]) for r in rows("benchmark")])
    want = {d["doc_id"]: LIBRARY.encode(d["text"]) for d in docs}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id: r.ids for r in got} == want and len(got) == len(want)
    assert all(r.n_tokens == len(r.ids) and r.decoded_sha256 == sha256(LIBRARY.decode(r.ids)) for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.dtypes == docs.dtypes, name
        changed = out.where("n_chars <> length(text)").join(docs.select("doc_id", "n_chars"), ["doc_id", "n_chars"], "left_anti")
        assert changed.count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0, name


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    numbers = [int(re.match(r"op(\d+)_", n)[1]) for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()
