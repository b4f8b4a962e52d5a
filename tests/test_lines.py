"""Lines through a point (one job a step) against the passes over the same ratings."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from latentspark.operators import lines
from latentspark.operators import objective as ob
from latentspark.operators.blocks import RatingBlocks
from latentspark.operators.params import Params, init_params
from latentspark.plans import descent
from latentspark.sources.synthetic import low_rank_ratings

K, LAM = 3, 0.01


@pytest.fixture(scope="module")
def problem(spark):
    r = low_rank_ratings(spark, 40, 30, K, density=0.6, seed=5).persist()
    return r, init_params(spark, 41, 33, K, seed=9, stddev=0.5).cut(), float(r.count())  # ids 40 and 30 to 32 have no ratings


@pytest.mark.parametrize("hot", [None, 20])
def test_a_line_has_the_loss_the_gradient_and_the_polynomial(problem, hot):
    r, x, n = problem
    blocks = RatingBlocks.of(r, per_block=60, hot=hot, sides=("grid",))
    assert blocks.n_blocks > 4
    prob = descent.Problem(r, K, LAM, n, blocks, shared=True)
    p, start = prob.start(x), prob.line(x)
    assert np.isclose(start.loss, p.loss, rtol=1e-12) and np.isclose(start.gg, p.gg, rtol=1e-12)
    line = prob.along(start, 0.0)
    assert np.allclose(line.c, prob.poly(p, "g"), rtol=1e-9)
    moved, there = prob.move(p, descent.combine(1.0, "x", -7.0, "g")), prob.along(line, 7.0, 0.3)
    assert np.isclose(there.loss, ob.poly_eval(line.c, 7.0), rtol=1e-12) and np.isclose(there.loss, moved.loss, rtol=1e-12)
    assert np.isclose(there.gg, moved.gg, rtol=1e-9)
    # g1 · (g1 − g0), and the slope along 0.3 s − g
    assert np.isclose(line.change(7.0), moved.gg - float(line.gram[1, 1:] @ [1, 7, 49, 343]), rtol=1e-9)
    assert np.isclose(there.c[1], there.gram[0, 1], rtol=1e-9)
    want = {(q["side"], q["id"]): q["x"] for q in moved.rows().collect()}
    got = {(q["side"], q["id"]): q["features"] for q in prob.end(there, 0.0).table().collect()}
    assert set(got) == set(want) and len(got) == 74 and all(np.allclose(got[i], want[i], atol=1e-12) for i in want)
    blocks.release()


def test_ratings_without_a_vector_and_null_ids_do_not_count(spark, problem):
    r, x, n = problem
    few = Params(x.uf.filter("id % 5 != 0").unionByName(spark.createDataFrame([(None, [1.0, 2.0, 3.0])], "id long, features array<double>")),
                 x.vf.filter("id % 7 != 0"))
    odd = r.unionByName(spark.createDataFrame([(None, 1, 3.0), (1, None, 3.0)], r.schema)) if r.schema["user"].nullable else r.selectExpr(
        "if(user = 1, null, user) user", "if(item = 2, null, item) item", "rating")
    prob = descent.Problem(odd, K, LAM, n)
    line, p = prob.along(prob.line(few), 0.0), prob.start(few)
    assert np.isclose(line.loss, p.loss, rtol=1e-12) and np.isclose(line.gg, p.gg, rtol=1e-12)
    ids = [q["id"] for q in prob.end(line, 0.0).table().collect()]
    assert ids.count(None) == 1 and len(ids) == few.table().count()
    prob.release()


def test_a_vector_that_lacks_a_number_counts_in_no_sum(spark, problem):
    r, x, n = problem
    odd = spark.createDataFrame([(None, [None, None, None]), (None, [1.0, 2.0, 3.0]), (77, [1.0, None, 2.0]), (78, None)],
                                "id long, features array<double>")
    prob = descent.Problem(r, K, LAM, n)
    at = Params(x.uf.unionByName(odd), x.vf)
    p, line = prob.start(at), prob.along(prob.line(at), 0.0)
    assert np.isclose(line.loss, p.loss, rtol=1e-12) and np.isclose(line.gg, p.gg, rtol=1e-12) and np.isfinite(line.c).all()
    found = sorted((q["id"] or 0, str(q["features"])) for q in prob.end(line, 0.0).table().filter("id IS NULL OR id > 70").collect())
    assert found == [(0, "[1.0, 2.0, 3.0]"), (0, "[None, None, None]"), (77, "[1.0, None, 2.0]"), (78, "[None, None, None]")]
    prob.release()
    fit = descent.fit_cg(prob, at, 3)
    assert all(np.isfinite(row["loss"]) for row in fit.trace.rows) and len(fit.trace.rows) == 4


def test_a_step_is_one_pass_over_the_ratings(problem, monkeypatch):
    """m7, m6 and m5 took two jobs over the ratings a step; no pass of the old kind is left in them, and a step has one line."""
    r, x, n = problem
    passes = []
    for name in ("poly_pass", "gradient_state"):
        monkeypatch.setattr(descent, name, lambda *a, name=name, **k: passes.append(name))
    line = lines._line
    monkeypatch.setattr(lines, "_line", lambda *a: passes.append("line") or line(*a))
    for fit, most in ((lambda p: descent.fit_cg(p, x, 4), 5), (lambda p: descent.fit_gd_linesearch(p, x, max_iter=4), 5),
                      (lambda p: descent.fit_gd_adaptive(p, x, 5.0, 1e-4, max_iter=4), 5)):
        passes.clear()
        found = fit(descent.Problem(r, K, LAM, n))
        assert set(passes) == {"line"} and len(passes) <= most and len(found.trace.rows) >= 4


def test_more_blocks_than_cores_come_in_whole_waves(spark, problem):
    cores = spark.sparkContext.defaultParallelism
    for sides in (("user",), ("grid",)):
        b = RatingBlocks.of(problem[0], per_block=100, sides=sides)
        assert b.n_blocks > cores and b.n_blocks % cores <= (b.n_blocks // 8 if sides == ("grid",) else 0)
        b.release()


def test_at_an_optimum_nothing_is_left_to_do(spark, problem):
    """Ratings that are the predictions themselves: no error, not even of rounding, so the trainers end at once."""
    from latentspark.operators.ratings import predict
    r, x, n = problem
    exact = predict(r, x.uf, x.vf, K).selectExpr("user", "item", "pred rating").persist()
    for trainer in (descent.fit_cg, lambda *a: descent.fit_gd_linesearch(*a, max_iter=3)):
        fit = trainer(descent.Problem(exact, K, 0.0, n), x)
        assert fit.converged and len(fit.trace.rows) <= 1
