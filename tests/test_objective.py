import numpy as np
from pyspark.sql import functions as F

from latentspark.operators import objective as ob
from latentspark.operators.diagnostics import check_mf_gradient, gradient_distance
from latentspark.operators.params import flatten_params, unflatten_params

from conftest import ALPHA, BETA, to_dict


def test_loss_zero_at_truth(exact):
    r, uf, vf = exact
    assert ob.loss(r, uf, vf, 2, 0.0, 1.0) < 1e-3


def test_loss_six_when_every_cell_off_by_one(exact):
    r, uf, vf = exact
    r1 = r.withColumn("rating", F.col("rating") + 1)
    assert abs(ob.loss(r1, uf, vf, 2, 0.0, 1.0) - 6.0) < 1e-3


def test_gradient_zero_at_optimum(exact):
    r, uf, vf = exact
    du, di = ob.gradient(r, uf, vf, 2, 0.0, 1.0)
    sq = sum(x * x for v in to_dict(du).values() for x in v) + sum(x * x for v in to_dict(di).values() for x in v)
    assert sq < 1e-12


def test_gradient_matches_central_difference(exact):
    r, uf, vf = exact
    rng = np.random.default_rng(3)
    noisy = r.withColumn("rating", F.col("rating") + F.lit(float(rng.normal())))
    for lam in (0.0, 0.5):
        c = check_mf_gradient(noisy, uf, vf, 2, lam, 1.0, 1e-3)
        assert c.count() == 14
        assert gradient_distance(c).first()["sq_dist"] < 1e-3


def test_gradient_matches_numpy(exact):
    r, uf, vf = exact
    A = np.array([ALPHA[i] for i in range(3)]).T
    B = np.array([BETA[i] for i in range(4)]).T
    Yn = A.T @ B + 1.0
    R = np.ones_like(Yn, dtype=bool)
    R[0, 1] = R[2, 3] = False
    lam, N = 0.3, 7.0
    delta = np.where(R, A.T @ B - Yn, 0.0)
    dA = (B @ delta.T + lam * A) / N
    dB = (A @ delta + lam * B) / N
    rows = [(u, i, float(Yn[u, i])) for u in range(3) for i in range(4) if R[u, i]]
    rr = r.sparkSession.createDataFrame(rows, "user int, item int, rating double")
    du, di = ob.gradient(rr, uf, vf, 2, lam, N)
    gu, gi = to_dict(du), to_dict(di)
    assert np.allclose(np.array([gu[i] for i in range(3)]).T, dA)
    assert np.allclose(np.array([gi[i] for i in range(4)]).T, dB)


def test_line_polynomial_is_exact(exact):
    r, uf, vf = exact
    r1 = r.withColumn("rating", F.col("rating") * 0.9)
    du, di = ob.gradient(r1, uf, vf, 2, 0.2, 12.0)
    c = ob.line_poly(r1, uf, vf, du, di, 2, 0.2, 12.0)
    from latentspark.operators.params import Params, move
    for a in (0.0, 0.01, 0.3, 2.0):
        x = move(Params(uf, vf), Params(du, di), -a)
        direct = ob.loss(r1, x.uf, x.vf, 2, 0.2, 12.0)
        assert abs(ob.poly_eval(c, a) - direct) <= 1e-9 * max(1.0, abs(direct))


def test_flatten_order_and_length(exact):
    _, uf, vf = exact
    flat = flatten_params(uf, vf, 3, 2).orderBy("pos")
    vals = [row["value"] for row in flat.collect()]
    assert vals == [1, 2, 3, 4, 5, 6, 8, 7, 6, 5, 4, 3, 2, 1]


def test_unflatten_shapes(spark):
    p = spark.createDataFrame([(i, float(i + 1)) for i in range(12)], "pos bigint, value double")
    u, v, rank = unflatten_params(p, 2, 2)
    assert rank == 3
    assert to_dict(u) == {0: [1, 2, 3], 1: [4, 5, 6]}
    assert to_dict(v) == {0: [7, 8, 9], 1: [10, 11, 12]}


def test_flatten_unflatten_round_trip(exact):
    _, uf, vf = exact
    u, v, rank = unflatten_params(flatten_params(uf, vf, 3, 2), 3, 4)
    assert rank == 2 and to_dict(u) == ALPHA and to_dict(v) == BETA
