"""Ratings laid out once: passes over blocks against the table operators, split ids, and plans that move no rating."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentspark.operators import objective as ob
from latentspark.operators.blocks import LOSS, RatingBlocks, gradient_pass, half_step, loss_pass, poly_pass
from latentspark.operators.params import Params
from latentspark.operators.regression import gram, solve_normal_equations
from latentspark.operators.solve import batched_solve

from conftest import to_dict

K, LAM, N = 3, 0.2, 7.0


@pytest.fixture(scope="module")
def problem(spark):
    rng = np.random.default_rng(4)
    # item 0 is rated by everyone: with a low bound it lies in several blocks
    cells = {(u, i) for u in range(40) for i in range(25) if i == 0 or rng.random() < 0.3}
    r = spark.createDataFrame([(u, i, float(rng.normal())) for u, i in sorted(cells)], "user long, item long, rating double").persist()
    side = lambda n: spark.createDataFrame([(i, rng.normal(size=K).tolist()) for i in range(n)], "id long, features array<double>")
    return r, Params(side(40), side(25)), Params(side(40), side(25))


@pytest.fixture(scope="module", params=[50_000, 7])
def blocks(request, problem):
    b = RatingBlocks.of(problem[0], per_block=60, hot=request.param)
    yield b
    b.release()


def test_half_steps_match_the_sum_columns(problem, blocks):
    r, x, _ = problem
    assert blocks.n_blocks > 1
    for out, fixed, f in (("item", "user", x.uf), ("user", "item", x.vf)):
        got = to_dict(half_step(blocks, f, out, K, LAM))
        j = r.join(f.select(F.col("id").alias(fixed), F.col("features").alias("v")), fixed)
        want = {row[out]: row["coef"] for row in solve_normal_equations(gram(j, [out], "v", "rating", k=K), K, LAM, [out]).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-10) for i in got)


def test_passes_match_the_table_operators(problem, blocks):
    r, x, d = problem
    rows = gradient_pass(blocks, x.table(), K, LAM, N).collect()
    got = {(row["side"], row["id"]): row["features"] for row in rows}
    du, di = ob.gradient(r, x.uf, x.vf, K, LAM, N)
    for s, frame in ((0, du), (1, di)):
        for i, v in to_dict(frame).items():
            assert np.allclose(got.pop((s, i)), v, atol=1e-10)
    assert set(got) == {(LOSS, 0)} and abs(got[LOSS, 0][0] - ob.loss(r, x.uf, x.vf, K, LAM, N)) < 1e-10
    assert abs(loss_pass(blocks, x.table(), K, LAM, N).first()["loss"] - ob.loss(r, x.uf, x.vf, K, LAM, N)) < 1e-10
    both = x.table().withColumnRenamed("features", "x").join(d.table().withColumnRenamed("features", "d"), ["side", "id"])
    c = [v for v in poly_pass(blocks, both, K, LAM, N).first()]
    assert np.allclose(c, ob.line_poly(r, x.uf, x.vf, d.uf, d.vf, K, LAM, N), atol=1e-10)


def test_squared_errors_come_with_the_half_step(problem, blocks):
    r, x, _ = problem
    got = half_step(blocks, x.vf, "user", K, LAM, scored=True).collect()
    v = to_dict(x.vf)
    want = {}
    u = {row["id"]: row["features"] for row in got}
    for row in r.collect():
        want[row["user"]] = want.get(row["user"], 0.0) + (row["rating"] - np.dot(u[row["user"]], v[row["item"]])) ** 2
    assert all(abs(row["sse"] - want[row["id"]]) < 1e-9 for row in got) and len(got) == len(want)
    got = half_step(blocks, x.uf, "item", K, LAM, scored=True).collect()         # item 0 may lie in several blocks
    u, v = to_dict(x.uf), {row["id"]: row["features"] for row in got}
    want = sum((row["rating"] - np.dot(u[row["user"]], v[row["item"]])) ** 2 for row in r.collect())
    assert abs(sum(row["sse"] for row in got) - want) < 1e-8


def test_every_block_has_its_partition_and_no_rating_moves(problem):
    r, x, _ = problem
    b = RatingBlocks.of(r, per_block=60)
    for side in ("user", "item"):
        placed = b.rows[side].select("block", F.spark_partition_id().alias("p")).distinct().collect()
        assert sorted(row["p"] for row in placed) == list(range(b.n_blocks)) and all(row["p"] == row["block"] for row in placed)
    plan = half_step(b, x.uf, "item", K, LAM)._jdf.queryExecution().executedPlan().toString()
    ratings_side = plan[plan.index("FlatMapCoGroupsInArrow"):].split("Exchange")[0]
    assert "InMemoryTableScan" in ratings_side  # the left side of the cogroup reads the layout without an exchange
    assert "Sort" not in ratings_side.split("InMemoryRelation")[0]  # nor a sort: it is stored in order
    b.release()


def test_messages_fall_with_the_size_of_a_block(problem):
    r, x, _ = problem
    sent = {}
    for per_block in (30, 300):
        b = RatingBlocks.of(r, per_block=per_block)
        sent[b.n_blocks] = b.messages("user", x.table().withColumnRenamed("features", "v"), K).count()
        b.release()
    few, many = min(sent), max(sent)
    assert few < many and sent[few] < sent[many]
    assert RatingBlocks.of(r).n_blocks == 1   # as many as cores only where there is work for them


def test_a_block_is_worked_through_in_slices(problem, monkeypatch):
    from latentspark.operators import blocks as bl
    r, x, _ = problem
    whole = RatingBlocks.of(r)
    rows = whole.rows["user"].toArrow()
    m = whole.messages("user", x.table().withColumnRenamed("features", "v"), K).toArrow()
    sizes = [len(p) for p, _, _ in bl._pairs(rows, m)[4]]
    monkeypatch.setattr(bl, "SLICE", 50)
    parts = [len(p) for p, _, _ in bl._pairs(rows, m)[4]]
    assert len(sizes) == 1 and max(parts) <= 50 and sum(parts) == sizes[0]
    whole.release()


def test_a_singular_system_leaves_its_neighbours_alone():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(5, 3, 3))
    g, b = a @ a.transpose(0, 2, 1), rng.normal(size=(5, 3))
    alone = batched_solve(g, b, 0.5)
    g2, b2 = np.concatenate([g, -0.5 * np.eye(3)[None]]), np.concatenate([b, np.ones((1, 3))])
    with_singular = batched_solve(g2, b2, 0.5)
    assert np.array_equal(alone, with_singular[:5]) and np.allclose(with_singular[5], 0)


def test_a_grid_sends_fewer_messages_and_gives_the_same_sums(problem):
    from latentspark.operators.blocks import grid_shape
    r, x, d = problem
    assert grid_shape(12, 10**6, 10**5, 100) == (12, 1)             # few items: by user
    p, q = grid_shape(106, 212_000_000, 3_600_000, 7_200_000, more=True)
    assert min(p, q) > 4 and 106 <= p * q <= 119
    sent, sums = {}, {}
    both = x.table().withColumnRenamed("features", "x").join(d.table().withColumnRenamed("features", "d"), ["side", "id"])
    for side in ("user", "grid"):
        for hot in (50_000, 7):
            b = RatingBlocks.of(r, per_block=10, hot=hot, sides=(side,))
            assert b.both == side and b.rows[side].count() == r.count()
            sent[side] = sent.get(side, 0) + b.messages(side, x.table().withColumnRenamed("features", "v"), K).count()
            g = {(row["side"], row["id"]): row["features"] for row in gradient_pass(b, x.table(), K, LAM, N).collect()}
            # vectors that carry their blocks need no join with the routes
            carried = b.routed(side, both)
            point = carried.selectExpr("side", "id", "x v", "blocks").localCheckpoint()
            assert "Join" not in b.messages(side, point, K)._jdf.queryExecution().executedPlan().toString()
            sums[side, hot] = g, list(poly_pass(b, carried, K, LAM, N).first()), loss_pass(b, x.table(), K, LAM, N).first()["loss"]
            b.release()
    assert sent["grid"] < sent["user"]
    g, c, loss = sums["user", 50_000]
    for g2, c2, loss2 in sums.values():
        assert g.keys() == g2.keys() and all(np.allclose(g[i], g2[i], atol=1e-10) for i in g)
        assert np.allclose(c, c2, atol=1e-10) and abs(loss - loss2) < 1e-10


def test_routes_shuffle_each_id_once_a_block_and_a_shared_layout_outlives_its_runs(problem):
    from latentspark.operators import blocks as bl
    from latentspark.plans.descent import Problem, fit_gd_fixed
    r, x, _ = problem
    b = RatingBlocks.of(r, per_block=60, sides=("grid",))
    rows = b.rows["grid"].select("block", "own", "other")
    want = {(row["block"], s, row[c]) for row in rows.collect() for s, c in ((0, "own"), (1, "other"))}
    for held in (1, 7, 1 << 18):
        ends = [tuple(row) for row in rows.mapInArrow(bl._ends(0, 1, held), "block int, side int, id long").collect()]
        assert len(ends) == len(want) and set(ends) == want
    assert {(k, row["side"], row["id"]) for row in b.routes["grid"].collect() for k in row["blocks"]} == want
    runs = [fit_gd_fixed(Problem(r, K, LAM, N, b, shared=True), x, 1e-4, 0.0, max_iter=2).trace.rows for _ in range(2)]
    assert runs[0] == runs[1] and b.rows["grid"].is_cached and b.routes["grid"].is_cached
    b.release()
    assert not b.rows["grid"].is_cached


def test_a_null_id_has_no_route(spark):
    from latentspark.operators import blocks as bl
    rows = spark.createDataFrame([(0, 1, None), (0, None, 5), (0, None, None), (1, 2, 5)], "block int, own long, other long").coalesce(1)
    ends = rows.mapInArrow(bl._ends(0, 1), "block int, side int, id long").collect()
    assert sorted(tuple(row) for row in ends) == [(0, 0, 1), (0, 1, 5), (1, 0, 2), (1, 1, 5)]


def test_grams_of_few_and_of_many_rows_agree():
    from latentspark.operators.blocks import MANY, _grams
    rng = np.random.default_rng(2)
    upper = np.triu_indices(4)
    for sizes in ([1, 3, MANY - 1], [MANY, 200, MANY + 5], [2, 300, 1, MANY, MANY - 1, 40, 7]):
        ends = np.cumsum(sizes)
        x = rng.normal(size=(ends[-1], 4))
        got = _grams(x, ends - sizes, ends, upper)
        want = [(x[e - n:e].T @ x[e - n:e])[upper] for n, e in zip(sizes, ends)]
        assert got.shape == (len(sizes), 10) and np.allclose(got, want, rtol=1e-12)
        # an id's sums do not depend on the ids beside it
        assert all((g == _grams(x[e - n:e], np.array([0]), np.array([n]), upper)[0]).all() for g, n, e in zip(got, sizes, ends))
