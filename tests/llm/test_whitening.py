"""Whitening against numpy's eigenvectors, exact whole numbers and awkward vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest

from maskloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, v string, component string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "v", "c") for i, v in vectors], SCHEMA)


def expected(vectors, count=16):
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    whole = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))])) for i, v in kept]
    fit = sorted({x for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    v = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(v)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    found = min(count, int((values > 1e-9 * max(values.max(), 1e-300)).sum()))
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in whole]
    rows = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for _, x in whole])
    return n, deviation, rows @ vectors_[:, :found] / np.sqrt(values[:found]), values[:found] / np.trace(v)


def check(df, vectors, components=16):
    n, deviation, wanted, explained = expected(vectors, components)
    rows = df.collect()
    count = len(explained)
    assert len(rows) == len(deviation) * count
    assert all(r["n"] == n and r["identity_error"] < 1e-9 for r in rows)
    assert sorted((str(r["vec_id"]), r["deviation"]) for r in rows if r["component"] == 1) == sorted((str(i), d) for i, d in deviation)
    for k in range(count):
        mine = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in rows if r["component"] == k + 1)
        order = sorted(range(len(deviation)), key=lambda j: (str(deviation[j][0]), deviation[j][1]))
        got, want = np.array([m[2] for m in mine]), wanted[order, k]
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
        assert all(abs(r["explained"] / explained[k] - 1) < 1e-9 for r in rows if r["component"] == k + 1)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    vectors = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(queries.op12_whitening(spark, sf), vectors)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    scales = np.array([300.0, 40, 9, 2, 0.5, 0])
    vectors = [(i, (rng.normal(size=6) * scales + 7).tolist()) for i in range(200)]
    vectors += [(3, vectors[3][1]), (500, vectors[4][1]), (None, vectors[5][1]), (501, [1.0, 2.0]), (502, [])]
    bad = [(600, None), (601, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (602, [float("nan")] * 6), (603, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0])]
    check(whitening.whiten(table(spark, vectors + bad)), vectors + bad)
    check(whitening.whiten(table(spark, vectors), components=2), vectors, 2)


def test_dependent_dimensions_have_fewer_components(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(a), float(b), float(a + b), 5.0]) for i, (a, b) in enumerate(rng.integers(-99, 99, (60, 2)))]
    df = whitening.whiten(table(spark, vectors))
    assert {r["component"] for r in df.select("component").collect()} == {1, 2}
    check(df, vectors)


def test_nothing_to_whiten(spark):
    for vectors in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(table(spark, vectors)).count() == 0


def test_huge_entries_do_not_crash(spark):
    rows = whitening.whiten(table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 5.0])])).collect()
    assert {r["vec_id"] for r in rows} == {1, 2, 3} and all(math.isfinite(r["whitened"]) for r in rows)
    assert {r["vec_id"]: r["deviation"] for r in rows}[1] is None


@pytest.mark.parametrize("rank", [1, 3, 8])
def test_factor_and_rotations(rank):
    rng = np.random.default_rng(rank)
    a = rng.normal(size=(8, rank)) * np.logspace(0, -5, rank)
    v = a @ a.T
    g = whitening.pivoted_cholesky(v)
    assert g.shape[1] <= 8 and np.allclose(g @ g.T, v, rtol=0, atol=1e-12)
    values, directions = whitening.one_sided_jacobi(g)
    assert np.allclose(values[:rank], np.linalg.svd(a, compute_uv=False) ** 2, rtol=1e-6)
    assert np.allclose(directions @ directions.T, np.eye(len(directions)), atol=1e-10)
