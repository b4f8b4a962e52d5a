"""Descent by fixed steps, many of them to a job (``operators.steps``), against numpy."""
import numpy as np

from latentspark.operators.params import Params
from latentspark.plans.descent import Problem, fit_gd_fixed

LAM, A, EPS = 0.01, 4.0, 0.002


def _problem(spark, users=60, items=40, seed=3):
    rng = np.random.default_rng(seed)
    cells = sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, users, 900), rng.integers(0, items, 900))})
    rows = [(u, i, float(1 + (u * 7 + i * 3) % 5)) for u, i in cells]
    x, v = rng.uniform(0.1, 1.0, (users, 2)), rng.uniform(0.1, 1.0, (items, 2))
    frame = lambda m: spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(m)], "id long, features array<double>")
    return rows, x, v, Params(frame(x), frame(v))


def _brute(rows, x, v, a, steps, eps=None):
    x, v, losses = x.copy(), v.copy(), []
    u, i, y = (np.array(c) for c in zip(*rows))
    for t in range(steps + 1):
        e = (x[u] * v[i]).sum(axis=1) - y
        if t:
            losses.append(0.5 * (e @ e + LAM * ((x * x).sum() + (v * v).sum())) / len(y))
            if eps is not None and len(losses) > 1 and abs(losses[-1] - losses[-2]) <= eps:
                return losses[:-1], x, v
        if t == steps:
            return losses, x, v
        gx, gv = LAM * x, LAM * v
        np.add.at(gx, u, e[:, None] * v[i])
        np.add.at(gv, i, e[:, None] * x[u])
        x, v = x - a * gx / len(y), v - a * gv / len(y)


def _vectors(f):
    return np.array([r["features"] for r in f.orderBy("id").collect()])


def test_stop_test_inside_a_job_and_fewer_jobs_than_steps(spark):
    rows, x, v, start = _problem(spark)
    losses, ex, ev = _brute(rows, x, v, A, 500, EPS)
    assert len(losses) > 24  # several jobs, and the last ends before its last step
    r = spark.createDataFrame(rows, "user long, item long, rating double")
    sc = spark.sparkContext

    def jobs(group, **kw):
        sc.setJobGroup(group, group)
        fit = fit_gd_fixed(Problem(r, 2, LAM, float(len(rows))), start, A, **kw)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return fit, len(sc.statusTracker().getJobIdsForGroup(group))

    fit, whole = jobs("to its test", eps=EPS)
    assert fit.converged and np.allclose([row["loss"] for row in fit.trace.rows], losses, rtol=1e-9)
    assert np.allclose(_vectors(fit.params.uf), ex, rtol=1e-9) and np.allclose(_vectors(fit.params.vf), ev, rtol=1e-9)
    short, few = jobs("two steps", eps=0.0, max_iter=2)
    assert len(short.trace.rows) == 2 and not short.converged
    assert whole - few < len(losses) - 2  # a job takes many steps
    fit.params.drop()
    short.params.drop()


def test_bound_and_no_step(spark):
    rows, x, v, start = _problem(spark, seed=5)
    r = spark.createDataFrame(rows, "user long, item long, rating double")
    for steps in (0, 1, 5):
        fit = fit_gd_fixed(Problem(r, 2, LAM, float(len(rows))), start, A, 0.0, max_iter=steps)
        losses, ex, ev = _brute(rows, x, v, A, steps)
        assert np.allclose([row["loss"] for row in fit.trace.rows], losses, rtol=1e-9) and not fit.converged
        assert np.allclose(_vectors(fit.params.uf), ex, rtol=1e-9) and np.allclose(_vectors(fit.params.vf), ev, rtol=1e-9)


def test_null_ids_missing_ids_and_repeated_cells(spark):
    rows, x, v, start = _problem(spark, seed=7)
    few = Params(start.uf.filter("id <> 3").unionByName(spark.createDataFrame([(None, [0.5, 0.25])], "id long, features array<double>")), start.vf)
    odd = [*rows, *rows[:5], (None, 1, 3.0), (2, None, 3.0), (1000, 1, 2.0)]
    n = float(len(odd))
    fit = fit_gd_fixed(Problem(spark.createDataFrame(odd, "user long, item long, rating double"), 2, LAM, n), few, A, 0.0, max_iter=1)
    u, i, y = (np.array(c) for c in zip(*[row for row in [*rows, *rows[:5]] if row[0] != 3]))
    e = (x[u] * v[i]).sum(axis=1) - y
    gx, gv = LAM * x, LAM * v
    np.add.at(gx, u, e[:, None] * v[i])
    np.add.at(gv, i, e[:, None] * x[u])
    ex, ev, alone = x - A * gx / n, v - A * gv / n, np.array([0.5, 0.25]) * (1 - A * LAM / n)
    e = (ex[u] * ev[i]).sum(axis=1) - y
    kept = np.arange(len(x)) != 3
    loss = 0.5 * (e @ e + LAM * ((ex[kept] ** 2).sum() + (ev ** 2).sum() + alone @ alone)) / n
    assert np.isclose(fit.trace.rows[0]["loss"], loss, rtol=1e-9)
    got = {row["id"]: row["features"] for row in fit.params.uf.collect()}
    assert np.allclose(got[None], alone) and np.allclose(got[2], ex[2]) and np.allclose(_vectors(fit.params.vf), ev)
