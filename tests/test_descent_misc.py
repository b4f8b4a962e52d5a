import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentspark.functions import pixels as px
from latentspark.operators.diagnostics import latest, numeric_gradient, shrink, verify_gradient, with_reduction
from latentspark.operators.params import Params, init_params
from latentspark.plans.descent import Problem, fit_cg, fit_gd_adaptive, fit_gd_fixed, exact_step, fit_gd_linesearch, stationary_steps, wolfe_step
from latentspark.sources.synthetic import low_rank_ratings

from conftest import to_dict


@pytest.fixture(scope="module")
def small_problem(spark):
    r = low_rank_ratings(spark, 20, 30, 3, density=0.8, seed=5).persist()
    n_ratings = r.count()
    x0 = init_params(spark, 20, 30, 3, seed=9, stddev=0.5)
    return Problem(r, 3, 0.01, float(n_ratings)), x0


def _dense(p: Params, n, m):
    U, V = to_dict(p.uf), to_dict(p.vf)
    return np.array([U[i] for i in range(n)]), np.array([V[i] for i in range(m)])


def test_fixed_step_matches_numpy(small_problem):
    prob, x0 = small_problem
    pdf = prob.ratings.toPandas()
    A, B = _dense(x0, 20, 30)
    N, lam, a = prob.normalizer, prob.lam, 5.0
    losses = []
    for _ in range(3):
        e = (A[pdf.user] * B[pdf.item]).sum(1) - pdf.rating.to_numpy()
        gA = np.zeros_like(A)
        gB = np.zeros_like(B)
        np.add.at(gA, pdf.user.to_numpy(), e[:, None] * B[pdf.item])
        np.add.at(gB, pdf.item.to_numpy(), e[:, None] * A[pdf.user])
        A, B = A - a * (gA + lam * A) / N, B - a * (gB + lam * B) / N
        e = (A[pdf.user] * B[pdf.item]).sum(1) - pdf.rating.to_numpy()
        losses.append(0.5 * (np.sum(e ** 2) + lam * np.sum(A ** 2) + lam * np.sum(B ** 2)) / N)
    fit = fit_gd_fixed(prob, x0, a, 0.0, max_iter=3)
    assert np.allclose([r["loss"] for r in fit.trace.rows], losses, rtol=1e-10)
    assert fit.trace.rows[0]["red"] == 0.5


@pytest.mark.parametrize("trainer", ["adaptive", "linesearch", "cg"])
def test_trainers_reduce_loss_monotonically(small_problem, trainer):
    prob, x0 = small_problem
    start = prob.loss(x0)
    if trainer == "adaptive":
        fit = fit_gd_adaptive(prob, x0, 5.0, 1e-4, max_iter=6)
    elif trainer == "linesearch":
        fit = fit_gd_linesearch(prob, x0, 1e-4, max_iter=6)
    else:
        fit = fit_cg(prob, x0, length=6)
    losses = [r["loss"] for r in fit.trace.rows]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    end = prob.loss(fit.params)
    assert end < start
    assert abs(end - losses[-1]) < 1e-9 * max(1.0, end)     # trace records the point returned


def test_exact_steps():
    assert exact_step((4.0, -4.0, 1.0, 0.0, 0.0)) == (2.0, 0.0)          # (a − 2)²
    # (a − 1)²(a − 4)² + a/10: two minima, the far one lower only without the slope term
    c = np.poly1d([1, -1]) ** 2 * np.poly1d([1, -4]) ** 2 + np.poly1d([0.1, 0])
    c = tuple(float(v) for v in c.coeffs[::-1])
    a, y = exact_step(c)
    assert abs(a - 1) < 0.02 and y < 0.11 and len(stationary_steps(c)) == 3
    assert wolfe_step(c) == a                                            # and it is the first one along the line
    assert exact_step((1.0, 2.0, 1.0, 0.0, 0.0)) == (0.0, 1.0)           # ascending: no step
    for flat in ((1.0, 0.0, 0.0, 0.0, 0.0), (1.0, float("nan"), 1.0, 0.0, 0.0)):
        assert stationary_steps(flat) == [] and wolfe_step(flat) is None


@pytest.mark.parametrize("start", ["optimum", "zero"])
def test_trainers_stop_at_stationary_points(spark, exact, start):
    r, uf, vf = exact
    if start == "zero":
        uf, vf = (f.select("id", F.transform("features", lambda x: x * 0).alias("features")) for f in (uf, vf))
    for trainer in (fit_cg, fit_gd_linesearch):
        fit = trainer(Problem(r, 2, 0.0, 12.0), Params(uf, vf))
        assert fit.converged and len(fit.trace.rows) <= 1
        assert to_dict(fit.params.uf) == to_dict(uf)


def test_trainers_run_to_their_own_stop_test(small_problem):
    prob, x0 = small_problem
    for fit in (fit_cg(prob, x0, eps=0.3), fit_gd_linesearch(prob, x0, 0.3), fit_gd_adaptive(prob, x0, 5.0, 0.3)):
        assert fit.converged
        losses = [r["loss"] for r in fit.trace.rows]
        assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:]))
    assert not fit_cg(prob, x0, length=1).converged
    assert not fit_gd_fixed(prob, x0, 1e40, 1e-6).converged  # diverges, and says so


def test_numeric_gradient_detects_wrong_gradient(spark):
    rng = np.random.default_rng(0)
    pts = spark.createDataFrame([(i, *map(float, rng.uniform(size=3))) for i in range(101)],
                                "id int, x0 double, x1 double, x2 double")
    f = lambda v: 3 * v["x0"] * v["x0"] * v["x0"] - 4 * v["x1"] * v["x0"] + 6 * v["x2"]
    right = {"x0": lambda v: 9 * v["x0"] * v["x0"] - 4 * v["x1"], "x1": lambda v: -4 * v["x0"],
             "x2": lambda v: F.lit(6.0) + 0 * v["x2"]}
    wrong = {"x0": right["x1"], "x1": right["x0"], "x2": right["x2"]}
    ok = verify_gradient(pts, f, right, ["x0", "x1", "x2"], 1e-3).agg(F.max("sq_dist")).first()[0]
    bad = verify_gradient(pts, f, wrong, ["x0", "x1", "x2"], 1e-3).agg(F.max("sq_dist")).first()[0]
    assert ok < 1e-3 and bad > 1e-3
    assert {"ng_x0", "ng_x1", "ng_x2"} <= set(numeric_gradient(pts, f, ["x0", "x1", "x2"]).columns)


def test_trace_windows(spark):
    h = spark.createDataFrame([(0, 8.0), (1, 4.0), (2, 3.0)], "iter int, loss double")
    w = shrink(with_reduction(h), 2).orderBy("iter").collect()
    assert [r["red"] for r in w] == [0.5, 0.5, 0.75]
    assert abs(w[2]["shrink"] - (1 - 0.625)) < 1e-12
    assert [r["iter"] for r in latest(w and with_reduction(h), 2).collect()] == [2, 1]


def test_pixel_hand_cases(spark):
    grey = (0 << 24) | (7 << 16) | (7 << 8) | 7
    green_max = (10 << 16) | (200 << 8) | 30            # g largest (Q4)
    one_each = (0 << 16) | (90 << 8) | 255              # r = 255, b = 0
    df = spark.createDataFrame([(grey,), (green_max,), (one_each,)], "px int")
    out = [r["s"] for r in df.select(px.stretch("px").alias("s")).collect()]
    to_u = lambda v: v & 0xFFFFFFFF
    assert out[0] == grey                                  # grey unchanged, alpha kept (Q5)
    r, g, b, a = to_u(out[1]) & 255, (to_u(out[1]) >> 8) & 255, (to_u(out[1]) >> 16) & 255, to_u(out[1]) >> 24
    assert (r, g, b, a) == (int(255 * 20 / 190), 255, 0, 255)
    assert to_u(out[2]) == (255 << 24) | (0 << 16) | (90 << 8) | 255   # colour unchanged, alpha 255
    back = df.select(px.from_unit(px.to_unit("px")).alias("p")).collect()[1]["p"]
    assert to_u(back) & 0xFFFFFF == green_max and to_u(back) >> 24 == 255


def test_model_store_round_trip_and_dispatch(spark, tmpdir_fresh):
    from latentspark.operators.seen_sets import seen_items
    from latentspark.plans.model import FactorModel, fit, fit_or_load, load_model, model_version, save_model
    uf = spark.createDataFrame([(0, [1.0, 2.0])], "id int, features array<double>")
    vf = spark.createDataFrame([(0, [3.0, 4.0]), (1, [5.0, 6.0])], "id int, features array<double>")
    seen = spark.createDataFrame([(0, 1)], "user int, item int")
    m = FactorModel(uf, vf, seen, None, {"rank": 2, "n_users": 1, "n_items": 2, "trainer": 3, "lam": 0.01,
                                         "eps": 0.001, "seed": 8})
    path = os.path.join(tmpdir_fresh, "model")
    assert model_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        load_model(spark, path)
    back = save_model(m, path)
    assert model_version(spark, path) == back.meta["version"]
    assert [tuple(r) for r in seen_items(back.seen).collect()] == [(0, 1)]
    assert to_dict(back.item_factors) == {0: [3.0, 4.0], 1: [5.0, 6.0]}
    assert load_model(spark, path).meta["rank"] == 2 and back.items is None
    r = spark.createDataFrame([(0, 0, 1.0)], "user int, item int, rating double")
    assert fit_or_load(r, path, reuse=True).meta["trainer"] == 3      # reused, not retrained
    with pytest.raises(ValueError):
        fit(r, trainer=7)


def _tiny(spark, c, seen=None):
    from latentspark.plans.model import FactorModel
    uf = spark.createDataFrame([(0, [c, 0.0]), (1, [0.0, c])], "id long, features array<double>")
    vf = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(4)], "id long, features array<double>")
    seen = seen if seen is not None else spark.createDataFrame([(0, 3)], "user long, item long")
    return FactorModel(uf, vf, seen, None, {"rank": 2, "n_users": 2, "n_items": 4, "trainer": 3, "lam": 0.01, "eps": 0.001, "seed": 8})


def test_a_save_that_fails_half_way_leaves_the_model_before_it(spark, tmpdir_fresh):
    from latentspark.operators.seen_sets import seen_items
    from latentspark.plans.model import fit_or_load, load_model, model_versions, save_model
    path = os.path.join(tmpdir_fresh, "model")
    first = save_model(_tiny(spark, 1.0), path)
    broken = spark.range(3).select(F.col("id").alias("user"), F.when(F.col("id") > 0, F.raise_error(F.lit("torn")).cast("long")).otherwise(1).alias("item"))
    with pytest.raises(Exception, match="torn"):
        save_model(_tiny(spark, 2.0, broken), path)
    assert os.path.exists(os.path.join(path, "versions")) and len(os.listdir(os.path.join(path, "versions"))) == 2
    back = load_model(spark, path)
    assert back.meta["version"] == first.meta["version"] and to_dict(back.user_factors)[0] == [1.0, 0.0]
    assert [tuple(r) for r in seen_items(back.seen).collect()] == [(0, 3)]
    r = spark.createDataFrame([(0, 0, 1.0)], "user int, item int, rating double")
    assert fit_or_load(r, path).meta["version"] == first.meta["version"]
    assert len(model_versions(spark, path)) == 1


def test_a_save_during_a_batch_leaves_it_on_one_version(spark, tmpdir_fresh):
    from latentspark.operators.recommend import recommend
    from latentspark.plans.model import drop_old_versions, model_versions, save_model
    from latentspark.streaming.requests import CurrentModel, seen_by
    path = os.path.join(tmpdir_fresh, "model")
    old = save_model(_tiny(spark, 1.0), path)
    current = CurrentModel(spark, path)
    model, packed = current.get()
    req = spark.createDataFrame([(0, 0), (1, 1)], "req_pos int, user long")
    answers = recommend(model.user_factors, None, seen_by(model.seen, req), req, k=2, packed=packed)
    new = save_model(_tiny(spark, -1.0, spark.createDataFrame([(0, 0)], "user long, item long")), path)   # while the batch runs
    got = {(r["user"], r["position"]): (r["item"], r["score"]) for r in answers.collect()}
    assert got == {(0, 1): (2, 2.0), (0, 2): (1, 1.0), (1, 1): (0, 1.0), (1, 2): (1, 1.0)}
    model, packed = current.get()                                   # the next batch has the new version
    assert model.meta["version"] == new.meta["version"]
    got = [r["item"] for r in recommend(model.user_factors, None, model.seen, req.filter("user = 0"), k=1, packed=packed).collect()]
    assert got == [1]
    assert drop_old_versions(spark, path, 1) == [old.meta["version"]] and len(model_versions(spark, path)) == 1
    third = save_model(_tiny(spark, 3.0), path, keep=2)
    assert [v for _, v in model_versions(spark, path)] == [new.meta["version"], third.meta["version"]]


def test_request_stream_answers_like_batch_and_reloads(spark, tmpdir_fresh):
    from latentspark.operators.recommend import recommend
    from latentspark.plans.model import FactorModel, save_model
    from latentspark.streaming.requests import CurrentModel, recommend_stream, seen_by
    rng = np.random.default_rng(2)
    uf = spark.createDataFrame([(u, rng.normal(size=2).tolist()) for u in range(6)], "id int, features array<double>")
    vf = spark.createDataFrame([(i, rng.normal(size=2).tolist()) for i in range(9)], "id int, features array<double>")
    r = spark.createDataFrame([(0, 1, 1.0), (2, 3, 1.0)], "user int, item int, rating double")
    meta = {"rank": 2, "n_users": 6, "n_items": 9, "trainer": 3, "lam": 0.01, "eps": 0.001, "seed": 8}
    inp, out, ck, store = (os.path.join(tmpdir_fresh, d) for d in ("in", "out", "ck", "model"))
    os.makedirs(inp)
    model = save_model(FactorModel(uf, vf, r.select("user", "item"), None, meta), store)
    req = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "req_pos int, user int")

    def answer_file(name, items):
        with open(os.path.join(inp, name), "w") as f:
            f.write("1, 2\n 0\n")
        recommend_stream(spark, inp, store, out, ck, k=3).awaitTermination()
        got = sorted((x["user"], x["position"], x["item"]) for x in spark.read.parquet(out).filter(F.col("file").endswith(name)).collect())
        want = sorted((x["user"], x["position"], x["item"]) for x in recommend(uf, items, r, req, k=3).collect())
        assert got == want
    answer_file("a.txt", vf)
    plan = seen_by(model.seen, req)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(user" in plan
    current = CurrentModel(spark, store)
    before = current.get()[0]
    assert current.get()[0] is before                       # same version: nothing is read again
    other = vf.select("id", F.transform("features", lambda x: -x).alias("features"))
    save_model(FactorModel(uf, other, r.select("user", "item"), None, meta), store)
    assert current.get()[0] is not before
    answer_file("b.txt", other)


def test_files_to_answers(spark, tmpdir_fresh):
    from latentspark.plans.model import answer_requests, recommender_from_files
    def write(name, text):
        path = os.path.join(tmpdir_fresh, name)
        with open(path, "w", encoding="ISO-8859-1") as f:
            f.write(text)
        return path
    ratings = write("u.data", "1 1 5\n2 1 4\n1 2 1\n2 2 2\n1\t3\t\n1 1 1\n2 3 4 99\n")
    titles = write("u.item", "1|Café\n2|Two \"x\"|more\n3|Three\n4\n")
    model = recommender_from_files(spark, ratings, titles, os.path.join(tmpdir_fresh, "m"), trainer=3, rank=1, lam=0.1, eps=0.1)
    assert model.meta["converged"] is True and (model.meta["n_users"], model.meta["n_items"]) == (2, 3)
    u, v = to_dict(model.user_factors), to_dict(model.item_factors)
    assert abs(u[0][0] * v[0][0] - 1) < abs(u[0][0] * v[0][0] - 5)     # the last line of (1, 1) counts
    lines = spark.createDataFrame([(" 0, 1",), ("7",), ("",)], "value string")
    told = answer_requests(model, lines, k=5).orderBy("line_id", "pos", "user", "line_no").collect()
    assert [x["line"] for x in told][:1] == ["Recommendation for user 0:"]
    assert [x["user"] for x in told] == [0, 0, 0, 1, 1]                # user 1 has rated all: header and blank line
    assert "Movie: Three" in told[1]["line"]
    again = recommender_from_files(spark, ratings, titles, os.path.join(tmpdir_fresh, "m"), trainer=1)
    assert again.meta["version"] == model.meta["version"]              # reused


def test_wide_ids(spark):
    from latentspark.operators.recommend import recommend
    from latentspark.operators.regression import als_half_step
    from latentspark.sources.text import parse_requests
    big = 1 << 40
    uf = spark.createDataFrame([(big + u, [1.0 + u, 2.0]) for u in range(3)], "id long, features array<double>")
    r = spark.createDataFrame([(big + u, big + i, float(u + i)) for u in range(3) for i in range(4) if u != i], "user long, item long, rating double")
    vf = als_half_step(r, uf, "user", "item", 2, 0.1)
    assert set(to_dict(vf)) == {big + i for i in range(4)}
    req = parse_requests(spark.createDataFrame([(f"{big}, 99999999999999999999 x {big + 1}",)], "value string"))
    recs = recommend(uf, vf, r, req, k=1, req_cols=("line_id", "pos")).collect()
    assert {(x["user"], x["item"]) for x in recs} == {(big, big), (big + 1, big + 1)}


def test_session_keeps_master_and_partitions(tmpdir_fresh):
    import subprocess
    import sys
    import textwrap
    script = os.path.join(tmpdir_fresh, "s.py")
    with open(script, "w") as f:
        f.write(textwrap.dedent("""
            from latentspark.session import build_session
            s = build_session()
            print("FOUND", s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions"))
            s.stop()
        """))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS":
           "--master local[3] --conf spark.sql.shuffle.partitions=400 --conf spark.ui.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, script], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "FOUND local[3] 400" in out
