import numpy as np
import pytest

from tradewell.llm.common import table
from tradewell.llm.feast import count_above, largest_eigenpairs
from tradewell.llm.queries import QUERIES
from tradewell.llm.whitening import deviations, from_keys, keys, whiten

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, component string, key int"


def turned(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0] * 3 + [4.0] * 2 + [1.0] * 7 + [0.5, 0.1, 0.1, 1e-3, 1e-6, 0.0, 0.0], [10.0 ** -i for i in range(9)],
    np.linspace(1, 2, 30), [3.0], [2.0] * 20, [7.0] + [0.0] * 9, [1e150, 2e150, 3e150]])
def test_eigenpairs(values):
    v = turned(np.array(values))
    e, u = largest_eigenpairs(v, 16)
    true = np.sort(values)[::-1]
    true = true[true > 1e-10 * true[0]][:16]
    assert len(e) == len(true) and np.allclose(e / true[0], true / true[0], atol=1e-13)
    assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12)
    assert np.abs(v / true[0] @ u - u * (e / true[0])).max() < 1e-12


def test_inertia():
    values = np.array([-3.0, -1.0, 0.5, 0.5, 2.0, 9.0])
    v = turned(values)
    assert [count_above(v, s) for s in (-4, -2, 0, 1, 3, 10)] == [6, 5, 4, 2, 1, 0]
    assert count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1 and count_above(np.zeros((3, 3)), 0.0) == 0
    assert largest_eigenpairs(np.zeros((4, 4)), 3)[0].size == 0


def test_keys():
    x = np.array([[0, 127, -128], [0, 128, 0], [-40000, 0, 1], [2 ** 61, -2 ** 61, 5]])
    k = keys(x)
    assert [b[0] for b in k] == [0, 1, 2, 3]
    import pyarrow as pa
    assert (from_keys(pa.array(k, pa.binary()), 3) == x).all()


def test_deviation_is_exact_or_null():
    x = np.array([[2 ** 31, -5], [7, 2 ** 40], [0, 3]])
    for n, sums in ((3, [2 ** 31, 2 ** 33]), (2 ** 31, [2 ** 62, 11])):
        got = deviations(x, n, sums).to_pylist()
        true = [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]
        assert got == [t if t < 2 ** 63 else None for t in true]


def brute(x, k):
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = (fit - s / n).T @ (fit - s / n) / n
    w, u = np.linalg.eigh(v)
    w, u = w[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ u / np.sqrt(w), w / np.trace(v)


def test_query_equals_brute_force(spark):
    rows = table(spark, SF, "embeddings").toPandas().sort_values("vec_id")
    n, dev, z, share = brute(np.floor(64 * np.array(rows.embedding.tolist(), float)).astype(np.int64) + 1_000_000, 16)
    got = QUERIES["op13_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    assert list(got.vec_id[::16]) == list(rows.vec_id) and set(got.n) == {n} and (got.deviation.to_numpy()[::16] == dev).all()
    mine = got.whitened.to_numpy().reshape(-1, 16)
    assert np.abs(mine * np.sign((mine * z).sum(0)) - z).max() < 1e-9
    assert np.allclose(got.explained.to_numpy()[:16], share, rtol=1e-10) and got.identity_error.max() < 1e-8
    assert got.identity_error.nunique() == 1


def test_odd_rows(spark):
    base = [(i, [float(i % 7), float(i % 3), 1.0], "c", 1) for i in range(30)]
    odd = [(100, None, "c", 1), (101, [None, 1.0, 1.0], "c", 1), (102, [float("nan")] * 3, "c", 1), (103, [1e300, 0.0, 0.0], "c", 1)]
    copies = base * 20 + [(None, [1.0], "c", 1), (105, [1.0, 0.0, 0.0], "c", 1)]
    df = spark.createDataFrame([*base, *odd, *copies], SCHEMA)
    got = whiten(df).toPandas()
    assert set(got.component) == {1, 2, 3} and len(got) == 3 * (30 + 600 + 2)
    x = np.array([[i % 7, i % 3, 1] for i in range(30)] + [[1, 0, 0]]) * 64 + 1_000_000
    n, dev, z, share = brute(x, 3)
    assert set(got.n) == {n} == {22}  # copies and padded rows count once
    one = got[got.vec_id == 105].sort_values("component")
    assert one.deviation.iloc[0] == dev[-1] and np.allclose(np.abs(one.whitened), np.abs(z[-1]))
    assert got.identity_error.max() < 1e-8 and np.allclose(one.explained, share)


def test_lower_rank_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "c", 1), (2, [2.0, 4.0], "c", 1)], SCHEMA)
    got = {(r.vec_id, r.component): (r.whitened, r.explained) for r in whiten(df).collect()}
    assert abs(abs(got[1, 1][0]) - 1) < 1e-12 and got[1, 1][1] == pytest.approx(1.0) and got[1, 2] == (None, 0.0)
    same = whiten(df.limit(1)).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in same] == [(0, None, 0.0)] * 2
    assert whiten(df.limit(0)).count() == 0
    assert whiten(spark.createDataFrame([(1, [], "c", 1)], SCHEMA)).count() == 0
