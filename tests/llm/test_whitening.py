import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st

from tidestock.llm import whitening
from tidestock.llm.queries import QUERIES
from tidestock.llm.secular import rank_one


def plain(rows):
    """Exact integers, then one decomposition of the whole covariance."""
    x = {k: [int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for k, v in rows}
    n, dim = len(x), len(next(iter(x.values())))
    sums = [sum(v[j] for v in x.values()) for j in range(dim)]
    off = {k: [n * c - s for c, s in zip(v, sums)] for k, v in x.items()}
    centred = np.array([[c / n for c in v] for v in off.values()])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    k = min(32, dim)
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    white = centred @ vectors / np.sqrt(values[:k])
    return n, {key: (sum(c * c for c in v), w) for (key, v), w in zip(off.items(), white)}, values[:k] / values.sum()


def check(got, rows):
    n, want, explained = plain(rows)
    assert len(got) == sum(len(w) for _, w in want.values()) and {r.n for r in got} == {n}
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-9
    signs = {}
    for r in got:
        deviation, white = want[r.vec_id]
        value = white[r.component - 1]
        if abs(value) > 0.5:
            signs.setdefault(r.component, np.sign(value) * np.sign(r.whitened))
    for r in got:
        deviation, white = want[r.vec_id]
        assert r.deviation == deviation
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.whitened == pytest.approx(signs[r.component] * white[r.component - 1], abs=1e-7)


def test_query_against_plain_version(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()]
    check(QUERIES["op12_eigen_whitening"](spark, FOLDER).collect(), rows)


def test_many_parts_and_unusable_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    fine = [(k, rng.normal(size=7).astype("f4").tolist()) for k in range(90)]
    odd = [(500, None), (501, []), (502, [1.0] * 6), (503, [float("nan")] + [0.0] * 6), (504, [float("inf")] * 7), (505, [None] + [0.0] * 6)]
    frame = spark.createDataFrame(odd + fine, "vec_id long, embedding array<float>").selectExpr("*", "1 as part", "'x' as payload", "2L as n")
    frame.repartition(23, "vec_id").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert whitening.FAN_IN < 23
    check(QUERIES["op12_eigen_whitening"](spark, str(tmp_path)).collect(), fine)


def test_degenerate_tables(spark, tmp_path):
    schema = "vec_id long, embedding array<float>, label int"
    for name, rows, n_rows in (
        ("empty", [], 0), ("null", [(1, None, 0)], 0), ("one", [(1, [1.0, 2.0], 0)], 2), ("same", [(k, [1.0, 2.0], 0) for k in range(9)], 18),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
        got = QUERIES["op12_eigen_whitening"](spark, f"{tmp_path}/{name}").collect()
        assert len(got) == n_rows and all(r.whitened is None and r.deviation == 0 and r.identity_error == 0 for r in got), name
    line = [(k, [float(k), 2.0 * k, 5.0], 0) for k in range(40)]
    spark.createDataFrame(line, schema).write.parquet(f"{tmp_path}/line/embeddings.parquet")
    got = QUERIES["op12_eigen_whitening"](spark, f"{tmp_path}/line").collect()
    assert all((r.whitened is None) == (r.component > 1) for r in got) and got[0].identity_error < 1e-12


def test_large_counts_stay_exact():
    model = whitening.Whitening(whitening.Grid(), 10**11, (10**17 + 7, -5), np.ones(2), np.eye(2), 2.0)
    x = np.array([[1_000_000, 3], [999_990, -(1 << 52)]])
    assert model.squares(x) == [(10**11 * a - 10**17 - 7) ** 2 + (10**11 * b + 5) ** 2 for a, b in x.tolist()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([0.0, 1.0, -1.0, 1e-9, 1e5, 0.3, 2.5]), min_size=5, max_size=5), max_size=12))
def test_rank_one_updates(vectors):
    values, basis = np.zeros(5), np.eye(5)
    for v in vectors:
        values, basis = rank_one(values, basis, np.array(v))
    whole = np.array(vectors).reshape(-1, 5)
    size = max(1.0, float((whole**2).sum()))
    assert np.abs(basis @ np.diag(values) @ basis.T - whole.T @ whole).max() <= 1e-12 * size
    assert np.abs(basis.T @ basis - np.eye(5)).max() < 1e-12 and (np.diff(values) >= -1e-12 * size).all()


def test_spectra_join_in_any_grouping():
    rng = np.random.default_rng(6)
    x = np.floor(64 * rng.normal(size=(200, 6))).astype(np.int64) + 1_000_000
    parts = []
    for a in range(0, 200, 23):
        own = whitening.Spectrum(6)
        own.add(x[a:a + 23])
        parts.append(own.pack())
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    for groups in ([parts], [parts[:2], parts[2:3], parts[3:]]):
        one = whitening.Spectrum.unpack(whitening.joined_spectra([whitening.joined_spectra(g) for g in groups]))
        assert one.n == 200 and one.sums == x.sum(axis=0).tolist()
        assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - scatter).max() < 1e-10 * np.abs(scatter).max()
