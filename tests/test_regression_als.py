import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from latentspark.operators import objective as ob
from latentspark.operators import regression as rg
from latentspark.operators.params import Params
from latentspark.plans.als import als_sweeps, fit_als

from conftest import to_dict


def _table(spark, X, y, c=None):
    c = np.ones(len(y)) if c is None else c
    rows = [(i, [float(v) for v in X[i]], float(y[i]), float(c[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "row int, x array<double>, y double, c double")


def _coef(df):
    return np.array(df.first()["coef"])


def test_ridge_lambda0_exact(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(20, 10))
    w = rng.normal(size=10)
    y = X @ w
    coef = _coef(rg.ridge(_table(spark, X, y), "x", "y", 0.0, k=10))
    assert np.sum((X @ coef - y) ** 2) < 1e-3


def test_ridge_lambda1_matches_closed_form(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(400, 20))
    y = rng.normal(size=400)
    coef = _coef(rg.ridge(_table(spark, X, y), "x", "y", 1.0, k=20))
    expect = np.linalg.pinv(X.T @ X + np.eye(20)) @ X.T @ y
    assert np.max((coef - expect) ** 2) < 1e-12


def test_filtered_equals_plain_for_unit_weights(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(500, 20))
    y = rng.normal(size=500)
    t = _table(spark, X, y, np.ones(500))
    for lam in (0.0, 0.7):
        a = _coef(rg.ridge(t, "x", "y", lam, k=20))
        b = _coef(rg.weighted_ridge(t, "x", "y", "c", lam, k=20))
        assert np.sum((a - b) ** 2) < 1e-3


def test_zero_one_filter_equals_ridge_on_kept_rows(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(100, 5))
    y = rng.normal(size=100)
    c = np.zeros(100)
    c[rng.choice(100, 10, replace=False)] = 1.0
    a = _coef(rg.weighted_ridge(_table(spark, X, y, c), "x", "y", "c", 0.0, k=5))
    keep = c == 1.0
    expect = np.linalg.pinv(X[keep].T @ X[keep]) @ X[keep].T @ y[keep]
    assert np.max((a - expect) ** 2) < 1e-3


def test_weighted_ridge_per_group(spark):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(3):
        X = rng.normal(size=(30, 2))
        w = rng.uniform(0.5, 2.0, size=30)
        y = X @ np.array([g + 1.0, -g]) + 0.01 * rng.normal(size=30)
        rows += [(g, float(a), float(b), float(t), float(ww)) for (a, b), t, ww in zip(X, y, w)]
    df = spark.createDataFrame(rows, "g int, a double, b double, y double, w double")
    res = {r["g"]: r["coef"] for r in rg.weighted_ridge(df, ["a", "b"], "y", "w", 0.1, by=["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "a", "b", "y", "w"])
    for g, part in pdf.groupby("g"):
        X, y, C = part[["a", "b"]].to_numpy(), part["y"].to_numpy(), np.diag(part["w"].to_numpy())
        expect = np.linalg.pinv(X.T @ C @ X + 0.1 * np.eye(2)) @ X.T @ C @ y
        assert np.allclose(res[g], expect)


def _low_rank(spark, n=12, m=15, k=2, seed=0, drop=0.2):
    rng = np.random.default_rng(seed)
    A, B = rng.normal(size=(n, k)), rng.normal(size=(m, k))
    Y = A @ B.T
    keep = rng.uniform(size=(n, m)) >= drop
    rows = [(u, i, float(Y[u, i])) for u in range(n) for i in range(m) if keep[u, i]]
    return spark.createDataFrame(rows, "user int, item int, rating double"), Y, keep


def test_half_step_zeroes_that_side_gradient(spark):
    r, _, _ = _low_rank(spark)
    rng = np.random.default_rng(7)
    uf = spark.createDataFrame([(u, rng.normal(size=2).tolist()) for u in range(12)], "id int, features array<double>")
    vf = rg.als_half_step(r, uf, "user", "item", 2, 0.3)
    _, di = ob.gradient(r, uf, vf, 2, 0.3, 1.0)
    assert sum(x * x for v in to_dict(di).values() for x in v) < 1e-3


def test_partial_gram_path_equals_sum_columns(spark):
    r, _, _ = _low_rank(spark, n=30, m=25, k=3)
    rng = np.random.default_rng(8)
    k = 14
    uf = spark.createDataFrame([(u, rng.normal(size=k).tolist()) for u in range(30)], "id int, features array<double>")
    a = to_dict(rg.als_half_step(r, uf, "user", "item", k, 0.5))       # numpy partial Grams (k > 12)
    j = r.join(uf.selectExpr("id as user", "features as x"), "user")
    g = rg.gram(j, ["item"], "x", "rating", k=k)
    b = to_dict(rg.solve_normal_equations(g, k, 0.5, ["item"], "features").withColumnRenamed("item", "id"))
    assert a.keys() == b.keys()
    assert max(np.max(np.abs(np.array(a[i]) - np.array(b[i]))) for i in a) < 1e-9


def test_second_sweep_reduces_error(spark):
    r, _, _ = _low_rank(spark)
    from latentspark.operators.params import init_params
    x0 = init_params(spark, 12, 15, 2, seed=3)
    x1 = als_sweeps(r, x0, 2, 0.01, 1, 12, 15)
    x2 = als_sweeps(r, x1, 2, 0.01, 1, 12, 15)
    assert ob.loss(r, x2.uf, x2.vf, 2, 0.0) <= ob.loss(r, x1.uf, x1.vf, 2, 0.0) + 1e-12


def test_als_recovers_low_rank(spark):
    r, Y, keep = _low_rank(spark, drop=0.0)
    fit = fit_als(r, rank=2, eps=1e-4, lam=0.0, max_iter=60, seed=4)
    U = np.array([to_dict(fit.params.uf)[i] for i in range(12)])
    V = np.array([to_dict(fit.params.vf)[i] for i in range(15)])
    assert np.sum((U @ V.T - Y) ** 2) < 1e-3
    losses = [row["loss"] for row in fit.trace.rows]
    assert len(losses) >= 2


def test_ids_without_ratings_get_zero_vector(spark):
    r, _, _ = _low_rank(spark)
    from latentspark.operators.params import init_params
    x0 = init_params(spark, 14, 15, 2, seed=3)      # users 12, 13 have no ratings
    x = als_sweeps(r, x0, 2, 0.1, 1, 14, 15)
    f = to_dict(x.uf)
    assert f[12] == [0.0, 0.0] and f[13] == [0.0, 0.0]


def test_library_blocks_grow_with_the_ratings(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS

    from latentspark.plans.als import fit_als_builtin
    given, plain = [], ALS.setNumBlocks
    monkeypatch.setattr(ALS, "setNumBlocks", lambda self, n: (given.append(n), plain(self, n))[1])
    r = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(30) for i in range(20) if (u * i) % 3], "user int, item int, rating double")
    n = r.count()
    many = fit_als_builtin(r, rank=2, max_iter=2, per_block=20)
    cores = spark.sparkContext.defaultParallelism
    assert n > 10 * 20 and len(given) == 1 and given[0] % cores == 0 and n / 20 <= given[0] < n / 20 + cores
    fit_als_builtin(r, rank=2, max_iter=2)
    fit_als_builtin(r, rank=2, max_iter=2, per_block=-(-n // 10), n_ratings=n)
    assert len(given) == 1  # few ratings: the library's own blocks
    assert many.uf.count() == 30 and many.vf.count() == 20
