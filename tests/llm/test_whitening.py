"""Operator 13 against a plain eigendecomposition."""
import numpy as np
import pytest

from strata.llm.whitening import _quotient_iteration, count_above, leading, whiten


def matrices():
    r = np.random.default_rng(0)
    for n in (1, 2, 3, 9, 40):
        a = r.normal(size=(n, n))
        yield a @ a.T
        yield np.eye(n) * 3
        yield np.outer(a[0], a[0])
        q, _ = np.linalg.qr(a)
        v = q @ np.diag(np.repeat(r.random(n), 2)[:n]) @ q.T        # every eigenvalue twice
        yield (v + v.T) / 2
        yield np.diag(np.arange(n, dtype=float))
        v = np.zeros((n, n))
        v[:n // 2, :n // 2] = 1.0
        yield v


@pytest.mark.parametrize("v", list(matrices()))
def test_leading_eigenvalues(v):
    want = np.linalg.eigvalsh(v)[::-1]
    got = leading(v, 4)
    rank = int((want > 1e-12 * max(want[0], 1e-300)).sum())
    assert len(got) == min(4, rank)
    assert np.allclose([s.value for s in got], want[:len(got)], rtol=0, atol=1e-12 * max(want[0], 1))
    x = np.array([s.vector for s in got]).reshape(len(got), len(v))
    assert np.allclose(x @ x.T, np.eye(len(got)), atol=1e-12)
    for k, s in enumerate(got, 1):
        assert np.linalg.norm(v @ s.vector - s.value * s.vector) < 1e-11 * want[0]
        assert s.above_upper < k <= s.above_lower


def test_shift_that_is_an_eigenvalue_to_the_last_bit(monkeypatch):
    v, solve = np.ones((20, 20)), np.linalg.solve           # 20 + 1e-15 is 20

    def strict(a, b):
        if (a == v - 20 * np.eye(20)).all():
            raise np.linalg.LinAlgError("Singular matrix")
        return solve(a, b)

    monkeypatch.setattr(np.linalg, "solve", strict)
    value, x = _quotient_iteration(v, 20.0, 20.0, [])
    assert abs(value - 20) < 1e-12
    assert np.allclose(np.abs(x), 20 ** -0.5, rtol=0, atol=1e-12)


def test_counts_of_indefinite_matrices():
    r = np.random.default_rng(1)
    for n in (1, 2, 5, 20):
        for _ in range(20):
            a = r.normal(size=(n, n)) * (r.random((n, n)) < 0.5)
            v = a + a.T
            np.fill_diagonal(v, 0)                  # one by one no pivot would do
            e = np.linalg.eigvalsh(v)
            s = r.normal()
            assert count_above(v, s) == (e > s).sum()


def reference(vectors, components=4):
    x = {i: np.floor(256 * np.array(v, dtype=float)) for i, v in vectors}
    u = np.unique(np.array(list(x.values())), axis=0)
    n, s = len(u), u.sum(axis=0)
    e, q = np.linalg.eigh(np.cov(u.T, bias=True).reshape(u.shape[1], -1))
    e, q = e[::-1][:components], q[:, ::-1][:, :components]
    return {i: (n, int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s))), (v - s / n) @ q / e ** 0.5) for i, v in x.items()}, e / np.trace(
        np.cov(u.T, bias=True).reshape(u.shape[1], -1))


def compare(got, want, shares, n_rows):
    assert len(got) == n_rows
    signs = {}
    for r in got:
        n, deviation, w = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
        if abs(w[r.component - 1]) > 1e-9:
            signs.setdefault(r.component, np.sign(w[r.component - 1] * r.whitened))
        assert r.whitened * signs.get(r.component, 1) == pytest.approx(w[r.component - 1], abs=1e-8)


def test_frame(spark):
    r = np.random.default_rng(2)
    good = [(i, (r.normal(size=6) * [5, 4, 3, 2, 1, 0.5]).tolist()) for i in range(60)]
    good += [(100 + i, good[0][1]) for i in range(30)]          # half of all rows are one vector
    bad = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [float("nan")] + [1.0] * 5), (203, [float("-inf")] + [1.0] * 5),
           (204, []), (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "z") for i, v in [*good, *bad, good[3]]],
                               "vec_id long, embedding array<double>, component string")
    want, shares = reference(good)
    got = whiten(df.repartition(4)).collect()
    compare(got, want, shares, 91 * 4)
    assert sum(r.vec_id == 3 for r in got) == 8


def test_parquet_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want, shares = reference([(r.vec_id, r.embedding) for r in df.collect()])
    compare(whiten(df).collect(), want, shares, df.count() * 4)


def test_few_or_no_directions(spark):
    make = lambda vs: spark.createDataFrame(list(enumerate(vs)), "vec_id long, embedding array<float>")
    assert whiten(make([])).collect() == []
    assert whiten(make([[1.0, 2.0]] * 3)).collect() == []                   # no spread at all
    line = whiten(make([[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]])).collect()     # one direction
    assert {(r.vec_id, r.component) for r in line} == {(0, 1), (1, 1), (2, 1)}
    assert sorted(abs(r.whitened) for r in line)[0] == pytest.approx(0) and line[0].explained == pytest.approx(1)
    null_id = spark.createDataFrame([(None, [0.0]), (1, [1.0])], "vec_id long, embedding array<float>")
    assert sorted(str(r.vec_id) for r in whiten(null_id).collect()) == ["1", "None"]


def test_huge_numbers(spark):
    big = [[3.0e12, 1.0], [-3.0e12, 2.0], [1.0, 7.0]]
    df = spark.createDataFrame(list(enumerate(big)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whiten(df).where("component = 1").collect()}
    want, _ = reference(list(enumerate(big)), 2)
    for i, (n, deviation, _) in want.items():
        assert got[i].n == n and got[i].deviation == (deviation if deviation < 2 ** 63 else None)
    endless = spark.createDataFrame([(0, [1e300, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert len(whiten(endless).collect()) >= 2
