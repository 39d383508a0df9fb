import numpy as np
import pytest

from masklens.llm.whitening import Centre, solve, whiten


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 7) for i, v in enumerate(vectors)],
                                 "vec_id long, embedding array<float>, component string, n int")


def by_brute_force(vectors, most=4):
    """(n, deviations, eigenvalues, whitened) from exact sums and a dense decomposition of the centred rows."""
    x = np.floor(256 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64).astype(object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    deviations = [int(((n * r - sums) ** 2).sum()) for r in x]
    centred = lambda r: ((n * r - sums) / n).astype(float)
    _, s, right = np.linalg.svd(centred(fit), full_matrices=False)
    e = s * s / n
    k = min(most, int((s > 1e-12 * s.max(initial=0)).sum()))
    return n, deviations, e, (centred(x) @ right[:k].T / np.sqrt(e[:k])), k


@pytest.mark.parametrize("kind", ["plain", "flat", "offset", "steep", "few"])
def test_whitening_equals_a_dense_decomposition(spark, tmp_path, kind):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(300, 7)) * np.array([5, 3, 2, 1, .5, .3, .1])
    if kind == "flat":  # a constant and a repeated dimension
        x[:, 4], x[:, 6] = 2.5, x[:, 5]
    elif kind == "offset":
        x[:, 2] += 40_000
    elif kind == "steep":
        x = x * np.array([1e6, 1, 1, 1, 1, 1, 1])
    elif kind == "few":
        x = x[:3]
    x = np.vstack([x, x[:20], x[:1], x[:1]]).astype(np.float32)
    n, deviations, e, white, k = by_brute_force(x)
    got = whiten(table(spark, [list(map(float, r)) for r in x]), str(tmp_path / "w")).collect()
    assert len(got) == k * len(x) and {r.component for r in got} == set(range(1, k + 1))
    signs = {}
    for r in got:
        want = white[r.vec_id, r.component - 1]
        if abs(want) > 1e-6:
            signs.setdefault(r.component, np.sign(want * r.whitened))
        far = deviations[r.vec_id]
        assert r.n == n and r.deviation == (far if far < 2 ** 63 else None)
        assert r.whitened * signs.get(r.component, 1) == pytest.approx(want, abs=1e-6, rel=1e-6)
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-6) and r.identity_error < 1e-6


def test_whitening_of_odd_rows(spark, tmp_path):
    odd = [[1.0, 2.0], None, [float("nan"), 1.0], [float("inf"), 0.0], [None, 1.0], [3.0], [], [-0.0, 0.0], [1.0, 2.0]]
    got = whiten(table(spark, odd), str(tmp_path / "a")).collect()
    assert sorted({r.vec_id for r in got}) == [0, 5, 6, 7, 8]  # shorter ones are filled with zeros
    assert {r.n for r in got} == {3} and {r.component for r in got} == {1, 2}
    one = {(r.vec_id, r.component): r.whitened for r in got}
    assert one[0, 1] == one[8, 1] and one[6, 2] == one[7, 2]
    assert whiten(table(spark, [[1.0, 2.0], [1.0, 2.0]]), str(tmp_path / "b")).count() == 0  # no variance
    assert whiten(table(spark, [[]]), str(tmp_path / "c")).count() == 0
    assert whiten(table(spark, [[1.0]]).limit(0), str(tmp_path / "d")).count() == 0
    far = whiten(table(spark, [[3e38, 0.0], [-3e38, 1.0], [0.0, 2.0]]), str(tmp_path / "e")).collect()
    assert {r.vec_id for r in far if r.deviation is None} == {0, 1} and all(np.isfinite(r.whitened) for r in far)  # beyond a long


def test_centre_is_exact_with_large_numbers():
    x = np.array([[2 ** 62, -2 ** 62], [2 ** 62 - 1, 5], [7, 7]], dtype=np.int64)
    sums = [sum(int(v) for v in x[:, j]) for j in range(2)]
    centre = Centre(3, np.array([s // 3 for s in sums]), np.array([s % 3 for s in sums]))
    assert [[int(v) * 3 for v in r] for r in centre.shifted(x)] == [[3 * int(v) - 3 * (s // 3) for v, s in zip(r, sums)] for r in x]
    assert centre.deviations(x) == [None] * 3
    factor = np.triu(np.arange(1.0, 10.0).reshape(3, 3))
    rows = np.arange(6.0).reshape(2, 3)
    assert np.allclose(solve(rows, factor) @ factor, rows)
