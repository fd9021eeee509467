"""Whitening against plain arithmetic: exact polynomials, roots, components, and the query's rows."""

from fractions import Fraction

import numpy as np
import pytest
from callweave.llm import catalog, whitening
from tables import FOLDER


def brute_polynomial(matrix):
    """Faddeev and LeVerrier over fractions, lowest power first."""
    d = len(matrix)
    a = [[Fraction(int(x)) for x in row] for row in matrix]
    m = [[Fraction(0)] * d for _ in range(d)]
    c = [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(sum(a[i][t] * m[t][i] for t in range(d)) for i in range(d)) / k)
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (5, 5), (7, 3), (6, 0)])
def test_polynomial(spark, d, rank):
    rng = np.random.default_rng(d)
    y = rng.integers(-10**6, 10**6, (rank, d)).astype(object)
    matrix = y.T @ y if rank else np.zeros((d, d), object)
    matrix = np.array([[int(x) for x in row] for row in matrix], object)
    assert whitening.characteristic_polynomial(spark, matrix) == brute_polynomial(matrix)


def test_roots():
    def of(roots):
        poly = [1]
        for r in roots:
            poly = [(poly[i - 1] if i else 0) - r * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
        return poly

    for roots in ([5], [3, 3, 3], [10**12, 10**12 + 1, 7, 7, 0, 0], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]):
        got, shift = whitening.greatest_roots(of(roots), 4)
        flat = [r for r, m in got for _ in range(m)][:4]
        want = sorted((r for r in roots if r), reverse=True)[:4]
        assert [abs(g - (w << shift)) <= 1 for g, w in zip(flat, want, strict=False)] == [True] * len(want)
        assert len(flat) >= len(want)


def brute(x, k):
    """Covariance of the integer entries in exact arithmetic, then numpy's eigenvectors."""
    n = len(x)
    y = np.floor(np.array(x, float) * 1024).astype(np.int64).astype(object) + 100_000
    s = y.sum(0)
    moved = y * n - s
    scatter = moved.T @ moved  # n^3 V
    v = np.array([[int(c) / n**3 for c in row] for row in scatter])
    e, axes = np.linalg.eigh(v)
    order = np.argsort(-e)[:k]
    return (moved * moved).sum(1), e[order], axes[:, order].T, moved.astype(float) / n, np.trace(v)


@pytest.mark.parametrize("kind", ["even", "far", "twins", "flat"])
def test_components(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((500, 12)) * np.linspace(3, 0.5, 12)
    if kind == "far":
        x = x * 0.01 + 9e5
    if kind == "twins":
        # two greatest eigenvalues agree to about one part in 10**9
        x = np.concatenate([x * 1e-3, *[[s * 3e5 * np.eye(12)[i] * (1 + 1e-9 * i)] for i in (0, 1) for s in (1, -1)]])
    if kind == "flat":
        x[:, 3:] = x[:, :1]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    fitted = whitening.fit(df)
    got = {r["vec_id"]: r for r in whitening.apply(df, fitted).collect()}
    deviation, e, axes, moved, trace = brute(x, 8)
    assert [int(got[i]["deviation"]) for i in range(len(x))] == deviation.tolist()
    live = [i for i in range(8) if fitted.deviations[i]]
    assert len(live) == (3 if kind == "flat" else 8)
    # beside eigenvalues 10**14 times as great, numpy's small ones are noise
    sure = live[:2] if kind == "twins" else live
    assert np.allclose(np.array(fitted.deviations)[sure] ** 2, e[sure], rtol=1e-6)
    assert np.allclose(np.array(fitted.explained)[live], e[live] / trace, rtol=1e-6)
    assert np.allclose(fitted.axes[live] @ fitted.axes[live].T, np.eye(len(live)), atol=1e-13)
    values = np.array([got[i]["whitened"] for i in range(len(x))], float)
    for i in range(8):
        if i not in live:
            assert np.isnan(values[:, i]).all()
        else:
            assert np.allclose(values[:, i], moved @ fitted.axes[i] / fitted.deviations[i], rtol=1e-9, atol=1e-9)
            if kind != "twins":
                assert abs(abs(fitted.axes[i] @ axes[i]) - 1) < 1e-9
    if kind == "twins":
        y = np.floor(x * 1024).astype(np.int64).astype(object)
        s = y * len(y) - y.sum(0)
        matrix = s.T @ s
        for i in (0, 1):
            axis = [Fraction(float(c)) for c in fitted.axes[i]]
            image = [sum(int(matrix[r, c]) * axis[c] for c in range(12)) for r in range(12)]
            root = sum(a * b for a, b in zip(image, axis)) / sum(a * a for a in axis)
            assert max(abs(a - root * b) for a, b in zip(image, axis)) <= root * Fraction(1, 10**15)
    assert whitening.identity_error(whitening.apply(df, fitted), fitted) < 1e-9


def test_query_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    deviation, e, axes, moved, trace = brute([r[1] for r in rows], 8)
    want = moved @ axes.T / np.sqrt(e)
    got = catalog.QUERIES["op11_embedding_whitening"](spark, FOLDER).collect()
    assert len(got) == 8 * len(rows)
    at = {r[0]: i for i, r in enumerate(rows)}
    first = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    sign = {c: np.sign(first[rows[0][0], c] * want[0, c - 1]) for c in range(1, 9)}
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == len(rows) and r["deviation"] == deviation[i]
        assert r["whitened"] == pytest.approx(sign[c + 1] * want[i, c], rel=1e-7, abs=1e-7)
        assert r["explained"] == pytest.approx(e[c] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    schema = "vec_id long, embedding array<double>, whitened string, cell int"
    rows = [
        (1, [0.5, 1.0], "x", 1), (1, [0.5, 1.0], "x", 1), (2, [1.5, -1.0], "x", 1), (None, [0.0, 0.0], None, None),
        (3, None, "x", 1), (4, [], "x", 1), (5, [None, 1.0], "x", 1), (6, [nan, 1.0], "x", 1), (7, [1.0, -inf], "x", 1),
        (8, [1.0, 2.0, 3.0], "x", 1), (9, [1e300, 0.0], "x", 1),
    ]
    df = spark.createDataFrame(rows, schema)
    fitted = whitening.fit(df)
    assert (fitted.dims, fitted.n, len(fitted.deviations)) == (2, 4, 2)
    out = whitening.apply(df, fitted)
    assert out.columns == ["vec_id", "embedding", "cell", "deviation", "whitened"]
    assert sorted(str(r["vec_id"]) for r in out.collect()) == ["1", "1", "2", "None"]
    empty = whitening.fit(df.limit(0))
    assert whitening.apply(df.limit(0), empty).collect() == [] and whitening.identity_error(df.limit(0), empty) == 0.0
    same = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<double>")
    fitted = whitening.fit(same)
    assert [(int(r["deviation"]), r["whitened"]) for r in whitening.apply(same, fitted).collect()] == [(0, [None, None])] * 2
