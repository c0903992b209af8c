import math

import numpy as np
import pytest

from postscope.llm import whitening as S


def expected(vectors, k):
    """n, deviations by vector, eigenpairs and trace, plainly."""
    xs = np.array(sorted({tuple(math.floor(64 * float(c)) + 1000000 for c in v) for v in vectors}))
    n, sums = len(xs), xs.sum(0)
    cov = np.cov((xs - sums // n).T.astype(float), bias=True).reshape(xs.shape[1], -1)
    e, u = np.linalg.eigh(cov)
    return n, sums, e[::-1][:k], u[:, ::-1][:, :k], np.trace(cov)


def check(rows, data, k):
    usable = [(i, v) for i, v in data if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums, e, u, trace = expected([v for _, v in usable], k)
    by = {}
    for r in rows:
        by.setdefault(r["id"], {})[r["component"]] = r
    assert len(rows) == len(usable) * k and {r["n"] for r in rows} == {n} and len({r["identity_error"] for r in rows}) == 1
    assert rows[0]["identity_error"] < 1e-9
    signs = np.ones(k)
    for at, (i, v) in enumerate(usable):
        x = np.array([math.floor(64 * float(c)) + 1000000 for c in v])
        w = (x - sums / n) @ u / np.sqrt(e)
        got = np.array([by[i][c]["whitened"] for c in range(1, k + 1)])
        if not at:
            signs = np.sign(w * got)
        assert np.allclose(got * signs, w, rtol=1e-6, atol=1e-7)
        assert {by[i][c]["deviation"] for c in by[i]} == {sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, sums))}
        assert np.allclose([by[i][c]["explained"] for c in range(1, k + 1)], e / trace, rtol=1e-9)


def test_query_equals_dense_eigenvectors(spark):
    rows = [r.asDict() | {"id": r["vec_id"]} for r in S.op13_whitening(spark, "/root/testdata/sf0.001").collect()]
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(rows, data, 16)


@pytest.mark.parametrize("d,k,most", [(5, 16, None), (300, 6, 24), (120, 16, 64), (1, 1, None)])
def test_pairs_of_an_operator(d, k, most):
    rng = np.random.default_rng(d)
    a = rng.standard_normal((d, d))
    a = a @ a.T / d
    calls = []
    values, vectors = S.leading_pairs(lambda x: calls.append(x.shape[1]) or a @ x, d, k, most)
    e, u = np.linalg.eigh(a)
    k = min(d, k)
    assert np.allclose(values, e[::-1][:k], rtol=1e-12) and len(calls) < 400
    assert np.allclose(np.abs((vectors * u[:, ::-1][:, :k]).sum(0)), 1, atol=1e-9)
    assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() < 1e-12 * e[-1]


def test_equal_and_missing_eigenvalues():
    a = np.diag([3.0, 3, 3, 2, 2, 0, 0, 0])
    values, vectors = S.leading_pairs(lambda x: a @ x, 8, 6)
    assert np.allclose(values, [3, 3, 3, 2, 2, 0], atol=1e-13) and np.allclose(vectors.T @ vectors, np.eye(6), atol=1e-12)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(k, rng.standard_normal(6).round(3).tolist()) for k in range(40)]
    data = good + [(100, good[0][1]), (0, good[1][1]), (101, None), (102, [1.0, None, 0, 0, 0, 0]), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5)]
    frame = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "a", 1) for i, v in data + [(105, [1.0]), (106, []), (None, good[2][1])]],
                                  "vec_id bigint, embedding array<double>, y string, component int")
    rows = S.whiten(frame, components=4).collect()
    check([r.asDict() for r in rows if r["id"] not in (0, None)], [x for x in data if x[0] != 0], 4)
    assert sum(r["id"] == 0 for r in rows) == 8 and sum(r["id"] is None for r in rows) == 4
    assert S.whiten(frame.limit(0)).collect() == []
    assert S.whiten(frame.where("vec_id = 100")).collect() == []  # one distinct vector has no direction


def test_hot_vector_and_huge_entries(spark):
    rows = [(k, [1.0, 2.0]) for k in range(50)] + [(50, [3.0, 5.0]), (51, [0.0, 1e300])]
    got = S.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), components=1).collect()
    assert {r["n"] for r in got} == {3} and len(got) == 52 and {r["deviation"] for r in got} == {None}
    wide = S.whiten(spark.createDataFrame([(1, [1e9, 0.5]), (2, [0.0, 0.25]), (3, [-2e8, 0.0])], "vec_id bigint, embedding array<double>"), components=1).collect()
    xs = [64 * 10 ** 9, 0, -128 * 10 ** 8]
    small = [32, 16, 0]
    assert [r["deviation"] for r in sorted(wide)] == [None if (t := (3 * x - sum(xs)) ** 2 + (3 * y - 48) ** 2) >= 2 ** 63 else t for x, y in zip(xs, small)]
