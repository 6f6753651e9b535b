import numpy as np
import pytest

from dimloom.llm import whitening

TABLE = "/root/testdata/sf0.001/embeddings.parquet"


def _spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 4.0, 3.0, 1e-3], [1.0] * 6, [2.0, 2.0, 2.0, 1.0, 1.0], [1e6, 1.0, 1e-6], [0.0, 0.0, 3.0], list(np.linspace(1, 40, 64)), [1.0, 1.0 + 1e-13, 2.0], [7.0]])
def test_components_like_a_dense_solver(values):
    a = _spectrum(values)
    e, v = whitening.components_of(a)
    assert np.allclose(e, sorted(values, reverse=True), atol=1e-13 * max(values), rtol=1e-12)
    assert np.allclose(v @ v.T, np.eye(len(values)), atol=1e-13)
    assert np.allclose(v @ a @ v.T, np.diag(e), atol=1e-13 * max(values))


def test_polar_factor_is_the_sign():
    a = _spectrum([3.0, 1e-9, -1e-9, -2.0])
    u = whitening.polar(a)
    assert np.allclose(u @ u, np.eye(4), atol=1e-12) and round(np.trace(u)) == 0 and np.allclose(u @ a, a @ u)


def test_query_like_brute_force(spark):
    rows = spark.read.parquet(TABLE)
    ids, vectors = zip(*[(r.vec_id, r.embedding) for r in rows.collect()])
    x = np.floor(64 * np.array(vectors, "float32").astype(float)).astype("int64") + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    want = (x - s / n) @ q / np.sqrt(e)
    got = whitening.components(rows, whitening.fit(rows)).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(x) and set(got["n"]) == {n}
    mine = got["whitened"].to_numpy().reshape(-1, 16)
    order = np.argsort(ids)
    assert np.allclose(np.abs(mine), np.abs(want[order]), atol=1e-9)
    assert np.allclose(np.sign(mine * want[order]).sum(axis=0).__abs__(), len(x), atol=2)
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 16)[0], e / np.trace(v), rtol=1e-10)
    assert got["identity_error"].iloc[0] < 1e-10
    dev = ((n * x - s) ** 2).sum(axis=1)[order]
    assert (got["deviation"].to_numpy().reshape(-1, 16) == dev[:, None]).all()


def test_odd_vectors_clashing_columns_and_other_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [0.5, -0.5]), (7, [0.9, 0.1]),
            (7, [0.9, 0.1]), (8, [1.0, 2.0, 3.0]), (9, [1e30, 0.0]), (10, [-0.3, 0.8])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS x", "2 AS row", "3 AS whitened", "4 AS deviation", "5 AS v")
    model = whitening.fit(df)
    assert model.n == 4 and model.identity_error < 1e-10
    out = whitening.whiten(df, model).select("row.vec_id", "row.whitened", "row.x", "whitened").collect()
    assert sorted(r[0] or 0 for r in out) == [0, 1, 7, 7, 10] and all(r[1] == 3 and r[2] == 1 and len(r[3]) == 2 for r in out)
    assert sorted(r.component for r in whitening.components(df, model).collect()) == [1] * 5 + [2] * 5


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], "vec_id long, embedding array<float>")
    got = whitening.components(same, whitening.fit(same)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, 0.0, 0.0, 0.0)] * 4
    none = same.limit(0)
    assert whitening.fit(none) is None and whitening.components(none, None).count() == 0
    line = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], "vec_id long, embedding array<float>")
    flat = whitening.fit(line)
    assert flat.identity_error < 1e-10 and {r.whitened for r in whitening.components(line, flat).filter("component = 2").collect()} == {0.0}


def test_deviation_beyond_64_bits_is_exact_or_null():
    y = np.array([[3 * 10**9, 1], [2**33, 0]], "int64")
    assert whitening._deviation(y) == [9 * 10**18 + 1, None]


def test_partials_are_added_in_a_tree(spark, monkeypatch):
    rows = spark.read.parquet(TABLE).repartition(7)
    whole = whitening.fit(rows)
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "settle", lambda df, name: df.repartition(9))
    tree = whitening.fit(rows)
    assert tree.n == whole.n and (tree.sums == whole.sums).all() and np.allclose(tree.values, whole.values, rtol=1e-12)
