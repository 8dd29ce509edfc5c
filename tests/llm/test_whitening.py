from collections import defaultdict

import numpy as np
import pytest

from textmill.llm.spectral import eigenvectors, polar
from textmill.llm.whitening import whiten_embeddings

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors(spark):
    def build(rows, kind="float", clash=False):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
        if clash:
            for name in ("x", "size", "part", "line", "numbers", "component", "entries", "place"):
                df = df.selectExpr("*", f"'q' AS {name}")
        return df

    return build


def random_rows(n, d, seed=0):
    rng = np.random.default_rng(seed)
    data = (rng.standard_normal((n, d)) * np.linspace(0.5, 0.1, d)).astype(np.float32)
    return [(i, row.tolist(), 0) for i, row in enumerate(data)]


def brute(rows, most):
    """Rows by id: n, deviation, projections up to the sign, shares; by ``eigh`` and Python's integers."""
    good = [(i, v) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    sizes = defaultdict(int)
    for _, v in good:
        sizes[len(v)] += 1
    size = max(sizes, key=lambda k: (sizes[k], k))
    good = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in good if len(v) == size]
    fit = np.array(sorted({tuple(v) for _, v in good}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1][:most], basis[:, ::-1][:, :most]
    out = []
    for i, v in good:
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))
        white = (np.array(v) - sums / n) @ basis / np.sqrt(values)
        for k in range(len(values)):
            out.append((i, k + 1, n, deviation, white[k], values[k] / np.trace(centred.T @ centred / n)))
    return out


def compare(got, want):
    assert len(got) == len(want)
    sign = {}
    for a, b in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert a[:4] == b[:4]
        if abs(b[4]) > 1e-3:
            sign.setdefault(b[1], np.sign(a[4] * b[4]))
        assert abs(a[4] - sign.get(b[1], 1) * b[4]) < 1e-6
        assert abs(a[5] - b[5]) < 1e-12
        assert a[6] < 1e-9


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_equals_eigh(vectors):
    rows = random_rows(300, 12)
    compare(rows_of(whiten_embeddings(vectors(rows), most=4)), brute(rows, 4))


def test_odd_rows(vectors):
    good = random_rows(80, 5, 3)
    one = good[7][1]
    odd = [
        (100, None, 1),
        (101, [NAN, 0.0, 0.0, 0.0, 0.0], 1),
        (102, [INF, 0.0, 0.0, 0.0, 0.0], 1),
        (103, [None, 0.0, 0.0, 0.0, 0.0], None),
        (104, [], 1),
        (105, [1.0, 2.0], 1),
        (106, one, None),
        (106, one, None),
        (None, one, 2),
        (107, [-0.0] * 5, 2),
    ]
    got = rows_of(whiten_embeddings(vectors(good + odd, clash=True), most=3))
    compare(got, brute(good + odd, 3))
    assert {r[0] for r in got} >= {106, 107, None} and not {r[0] for r in got} & set(range(100, 106))


def test_hot_vector_counts_once(vectors):
    rows = random_rows(60, 6, 4)
    hot = [(1000 + i, rows[0][1], 0) for i in range(300)]
    compare(rows_of(whiten_embeddings(vectors(rows + hot), most=2)), brute(rows + hot, 2))


def test_no_rows_and_no_variance(vectors):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 0)], [(1, [0.5, 0.5], 0)] * 3, [(1, [], 0)]):
        out = whiten_embeddings(vectors(rows))
        assert out.columns == names and out.count() == 0


def test_rank_below_dimension(vectors):
    rows = [(i, [float(i), float(i), 2.0], 0) for i in range(10)]
    got = rows_of(whiten_embeddings(vectors(rows)))
    assert {r[1] for r in got} == {1} and all(abs(r[5] - 1) < 1e-12 for r in got)


def test_deviation_beyond_64_bits(vectors):
    rows = [(1, [1e9, 0.0], 0), (2, [-1e9, 1.0], 0), (3, [0.25, 0.5], 0), (4, [1e300, -1e300], 0)]
    got = {r[0]: r[3] for r in rows_of(whiten_embeddings(vectors(rows, "double"), most=1))}
    assert got[4] is None and got[1] is None and len(got) == 4
    small = [(1, [3e4, 0.0], 0), (2, [-3e4, 1.0], 0), (3, [0.25, 0.5], 0)]
    compare(rows_of(whiten_embeddings(vectors(small, "double"), most=1)), brute(small, 1))


@pytest.mark.parametrize("values", [[3, 2, 1], [1, 1, 1, 5, 5, 0], [0] * 4, [1, 1 + 1e-9, 1e-9, 0, 0], list(range(40))])
def test_spectral_divide_and_conquer(values):
    rng = np.random.default_rng(1)
    n = len(values)
    basis = np.linalg.qr(rng.standard_normal((n, n)))[0]
    a = basis @ np.diag(np.array(values, float)) @ basis.T
    found, vectors = eigenvectors(a)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-13 * max(1, max(values)))
    assert np.abs(vectors.T @ vectors - np.eye(n)).max() < 1e-13
    assert np.abs(a @ vectors - vectors * found).max() < 1e-12 * max(1, max(values))
    assert np.allclose(eigenvectors(a, 2)[0], sorted(values, reverse=True)[:2], atol=1e-13 * max(1, max(values)))


def test_polar_factor_is_the_sign():
    rng = np.random.default_rng(2)
    basis = np.linalg.qr(rng.standard_normal((6, 6)))[0]
    a = basis @ np.diag([5.0, 1e-9, -3, -1e-6, 2, -8]) @ basis.T
    assert np.abs(polar(a) - basis @ np.diag([1.0, 1, -1, -1, 1, -1]) @ basis.T).max() < 1e-6
