import math

import numpy as np
import pytest

from gavelline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(rows):
    good = [(i, [float(c) for c in e]) for i, e, *_ in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    sizes = [len(e) for _, e in good]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    return [(i, [math.floor(64 * c) + 1_000_000 for c in e]) for i, e in good if len(e) == d]


def check(rows, out, most=16):
    """Compares with a library's eigenvectors of the distinct vectors' covariance."""
    x = usable(rows)
    fit = np.array(sorted({tuple(v) for _, v in x}), float)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    k = int((e > 1e-12 * e[0]).sum())
    assert len(out) == len(x) * k
    trace = (centred**2).sum() / n
    by_id = {}
    for r in out:
        assert r.n == n and r.identity_error <= 1e-4
        assert abs(r.explained - e[r.component - 1] / trace) <= 1e-9
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, v in x:
        assert sorted(by_id[i]) == list(range(1, k + 1))
        exact = sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
        for c, found in by_id[i].items():
            want = (np.array(v) - sums / n) @ q[:, c - 1] / np.sqrt(e[c - 1])
            for r in found:
                assert r.deviation == exact
                if abs(want) > 1e-6:
                    assert signs.setdefault(c, np.sign(r.whitened * want)) == np.sign(r.whitened * want)
                assert abs(abs(r.whitened) - abs(want)) < 1e-8


@pytest.mark.parametrize("d", [1, 2, 3, 7, 16, 40, 129])
def test_decomposition(d):
    draw = np.random.default_rng(d)
    a = draw.normal(size=(d, 2 * d + 1))
    a = a @ a.T
    value, vector = whitening.components_of(a)
    np.testing.assert_allclose(value, np.linalg.eigvalsh(a)[::-1], atol=1e-12 * np.abs(a).max() * d)
    np.testing.assert_allclose(vector.T @ vector, np.eye(d), atol=1e-13 * max(d, 10))
    np.testing.assert_allclose(a @ vector, vector * value, atol=1e-12 * np.abs(a).max() * d)
    first, some = whitening.components_of(a, 3)
    np.testing.assert_allclose(first, value[:3], atol=1e-12 * np.abs(a).max() * d)
    assert some.shape == (d, min(3, d))


@pytest.mark.parametrize("values", [
    [1, 1, 1, 1], [5, 5, 5, 2, 2, 1e-8, 0, 0], [1, 1 + 1e-15, 1 - 1e-15, 3], [1, 1 + 1e-9, 1 - 1e-9, 1 + 2e-9, 0, 0, 0, 0],
    [10.0**-k for k in range(16)], [1e6] + [1] * 30 + [1e-6] * 30, [0, 0, 0], [7], [2, -1, 3],
])
def test_equal_and_wide_eigenvalues(values):
    d = len(values)
    turn, _ = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    for q in (turn, np.eye(d)):
        a = q @ np.diag(np.array(values, float)) @ q.T
        value, vector = whitening.components_of(a)
        np.testing.assert_allclose(value, sorted(values, reverse=True), atol=1e-14 * d * max(map(abs, values)))
        np.testing.assert_allclose(vector.T @ vector, np.eye(d), atol=1e-13)
        np.testing.assert_allclose(a @ vector, vector * value, atol=1e-14 * d * max(1, *map(abs, values)))


@pytest.mark.parametrize("low", [1.0, 1e-3, 1e-9])
def test_polar_factor(low):
    draw = np.random.default_rng(2)
    u, _ = np.linalg.qr(draw.normal(size=(9, 9)))
    a = u @ np.diag(np.concatenate([np.linspace(1, low, 5), -np.linspace(low, 2, 4)])) @ u.T
    np.testing.assert_allclose(whitening.polar(a), u @ np.diag([1.0] * 5 + [-1.0] * 4) @ u.T, atol=1e-5 if low < 1e-6 else 1e-11)


def test_tables_against_a_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(rows.collect(), whitening.whitened(rows).collect())


def test_awkward_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [(k, draw.normal(size=5).tolist(), 1) for k in range(40)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0, 0.0], 0), (102, [1.0, float("nan"), 0.0, 0.0, 0.0], 0), (103, [], 0)]
    rows += [(104, [float("inf")] * 5, 0), (105, [1.0, 2.0], 0), (0, rows[0][1], 0), (106, rows[3][1], None), (None, [0.0] * 5, 0)]
    rows += [(107, [-0.0] * 5, 0), (108, [1e-40] * 5, 0)]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA + ", x string, n int")
    check(rows, whitening.whitened(df).collect())
    one, other = (sorted(whitening.whitened(d).collect(), key=lambda r: (str(r.vec_id), r.component)) for d in (df.repartition(7, "label"), df.coalesce(1)))
    assert [r[:4] + (r.explained,) for r in one] == [r[:4] + (r.explained,) for r in other]
    np.testing.assert_allclose([r.whitened for r in one], [r.whitened for r in other], atol=1e-13)


def test_few_or_equal_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []
    rows = [(1, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 5.0], 0), (3, [1.0, 2.0, 5.0], 0)]
    check(rows, whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_large_entries_stay_exact(spark):
    draw = np.random.default_rng(8)
    rows = [(k, [float(np.float32(c)) for c in draw.normal(size=3) * 1e6], 0) for k in range(12)] + [(50, [3e9, -3e9, 0.0], 0)]
    out = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    x = usable(rows)
    sums = [sum(v[j] for _, v in x) for j in range(3)]
    for i, v in x:
        exact = sum((len(x) * a - s) ** 2 for a, s in zip(v, sums))
        assert {r.deviation for r in out if r.vec_id == i} == {exact if exact < 1 << 63 else None}
    assert {r.identity_error <= 1e-4 for r in out} == {True}
