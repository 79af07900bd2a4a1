"""Whitening: dense brute force, eigenpairs, clusters, copies, edge rows."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import eigen, whiten
from tests.conftest import SF


def slow(rows, k=4):
    """Exact fit list and deviations, covariance in doubles, numpy's eigh."""
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(256 * Fraction(c)) for c in v)) for i, v in usable]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, sums)] for v in fit])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1][:k], vectors[:, ::-1].T[:k]
    out = []
    for i, v in x:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        at = np.array([float(Fraction(c) - Fraction(s, n)) for c, s in zip(v, sums)])
        out += [(i, j + 1, n, deviation, float(at @ vectors[j] / math.sqrt(e[j])), float(e[j] / np.trace(centred.T @ centred / n))) for j in range(k)]
    return out


def check(got, want, tight=1e-9):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got), key=lambda r: (r[0] is None, *r[:2], abs(r[4])))
    want = sorted(want, key=lambda r: (r[0] is None, *r[:2], abs(r[4])))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    sign = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-6:
            sign.setdefault(g[1], math.copysign(1, g[4] * w[4]))
        assert abs(g[4] * sign.get(g[1], 1) - w[4]) < tight * max(1, abs(w[4])) and abs(g[5] - w[5]) < 1e-10


def test_given_embeddings_match_brute_force(spark):
    emb = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = whiten.whiten(emb).collect()
    check(got, slow([(r["vec_id"], r["embedding"]) for r in emb.collect()]))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_edge_rows(spark):
    """Nulls, non-finite and empty vectors, copies, another length, clashing names."""
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(40)]
    rows = good + [good[0]] * 30 + [(None, good[1][1]), (90, [-0.0] * 6), (91, [0.0] * 6), (92, [300.0, -1.0, 0.5, 40.0, 1.0, 2.0])]
    bad = [(50, None), (51, []), (52, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (53, [float("nan")] * 6), (54, [float("inf")] * 6), (55, [1.0] * 5), (56, [1.0] * 7)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    df = df.withColumns({c: F.lit("x") for c in ("vector", "key", "component", "n", "task", "part", "i")}).repartition(5)
    check(whiten.whiten(df).collect(), slow(rows))


def test_sums_in_several_parts_and_levels(spark, monkeypatch):
    monkeypatch.setattr(whiten, "PART", 7)
    emb = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(9)
    check(whiten.whiten(emb).collect(), slow([(r["vec_id"], r["embedding"]) for r in emb.collect()]))


def test_deviation_beyond_a_long_is_null_and_exact_below(spark):
    rows = [(1, [1e6, 0.0]), (2, [-1e6, 3.0]), (3, [0.0, 1.0]), (4, [1e18, 1e18]), (5, [-1e300, 2.0])]
    df = spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")
    check(whiten.whiten(df, most=1).collect(), slow(rows[:3], 1))
    far = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in far if r["vec_id"] == 4} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])] * 3])
def test_tables_without_components(spark, rows):
    assert whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_flat_directions_have_no_component(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    got = whiten.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


@pytest.mark.parametrize("kind", ["random", "cluster", "equal", "diagonal", "split", "wide"])
def test_eigenpairs(kind):
    rng = np.random.default_rng(5)
    n = 200 if kind == "wide" else 40
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = np.sort(rng.uniform(0.1, 5, n))[::-1]
    if kind == "cluster":
        values[:4] = 9 + np.array([3e-9, 2e-9, 1e-9, 0])
    if kind == "equal":
        values[:3] = 7.0
    a = np.diag(values) if kind == "diagonal" else q @ np.diag(values) @ q.T
    if kind == "split":
        a = np.block([[a[:20, :20], np.zeros((20, 20))], [np.zeros((20, 20)), a[20:, 20:]]])
    a = (a + a.T) / 2
    e, v = eigen.leading(a, 4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    assert np.allclose(e, want, rtol=1e-13, atol=0)
    assert np.abs(v @ v.T - np.eye(4)).max() < 1e-12 and np.abs(a @ v.T - v.T * e).max() < 1e-12 * np.abs(want[0])
    d, off, _ = eigen.tridiagonal(a)
    assert eigen.counts_below(d, off, np.array([want[3] - 1e-6, want[0] + 1e-6])).tolist() == [int((np.linalg.eigvalsh(a) < want[3] - 1e-6).sum()), n]
