"""Optimality certificate, orthogonal ridge, image and line sinks: each against an independent computation, and faults that must show."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from latentspark.operators.optimality import nnls_violations
from latentspark.operators.orthogonal import ridge_qr, solve_triangle, triangle


def test_certificate_accepts_the_library_and_rejects_perturbed_factors(spark):
    from latentspark.plans.als import fit_als_builtin
    rng = np.random.default_rng(4)
    r = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if rng.random() < 0.5],
                              "user int, item int, rating double").persist()
    x = fit_als_builtin(r, rank=4, lam=0.1)

    def violating(f, tolerance=1e-5):
        rows = nnls_violations(r, f, x.vf, "user", "item", 4, 0.1).collect()
        assert sum(row["n"] for row in rows) == r.count()
        return {row["id"] for row in rows if not row["violation"] <= tolerance * row["scale"]}
    assert violating(x.uf) == set()
    moved = lambda c: x.uf.select("id", F.when(F.col("id") == 7, F.transform("features", c)).otherwise(F.col("features")).alias("features"))
    assert violating(moved(lambda v: v * 1.01)) == {7}
    assert violating(moved(lambda v: v * 0)) == {7}             # feasible, but not optimal
    assert violating(moved(lambda v: v - 5)) == {7}             # negative
    assert violating(moved(lambda v: v * float("nan"))) == {7}
    r.unpersist()


def test_certificate_of_a_bound_component(spark):
    # min ½(u·v − y)² + ½λ|u|² with v = (1, 1), y = −1: u = 0, the gradient there is (1, 1)
    r = spark.createDataFrame([(0, 0, -1.0)], "user int, item int, rating double")
    v = spark.createDataFrame([(0, [1.0, 1.0])], "id int, features array<double>")
    for u, bad in (([0.0, 0.0], False), ([0.1, 0.0], True)):
        row = nnls_violations(r, spark.createDataFrame([(0, u)], "id int, features array<double>"), v, "user", "item", 2, 0.1).first()
        assert (row["violation"] > 0.05) == bad


def test_orthogonal_ridge_on_columns_a_millionth_apart(spark):
    rng = np.random.default_rng(1)
    n = 6000
    x = rng.normal(size=n)
    z = x + 1e-6 * rng.normal(size=n)
    y = 2 * x - 3 * z
    g = np.arange(n) % 3
    df = spark.createDataFrame([(int(a), float(b), float(c), float(e)) for a, b, c, e in zip(g, x, z, y)],
                               "g int, x double, z double, y double").repartition(7)
    for fan in (2, 64):
        got = {r["g"]: r["coef"] for r in ridge_qr(df, ["x", "z"], "y", 0.0, by=["g"], fan=fan).collect()}
        assert got.keys() == {0, 1, 2} and all(np.allclose(c, [2, -3], atol=1e-6) for c in got.values())
    assert np.allclose(ridge_qr(df, ["x", "z"], "y", 0.0).first()["coef"], [2, -3], atol=1e-6)


def test_orthogonal_ridge_equals_the_sums_where_those_are_right(spark):
    from latentspark.operators.regression import weighted_ridge
    rng = np.random.default_rng(2)
    rows = [(None if i % 50 == 0 else i % 4, float(rng.normal()), float(rng.normal()), float(rng.normal()), float(i % 3)) for i in range(500)]
    df = spark.createDataFrame(rows + [(9, 1.0, 2.0, 3.0, 1.0), (1, None, 1.0, 1.0, 1.0)], "g int, a double, b double, y double, w double")
    a = {r["g"]: r["coef"] for r in ridge_qr(df, ["a", "b"], "y", 0.5, "w", ["g"]).collect()}
    b = {r["g"]: r["coef"] for r in weighted_ridge(df.dropna(subset=["a", "b", "y", "w"]), ["a", "b"], "y", "w", 0.5, ["g"]).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-10) for k in a)
    # fewer rows than columns: the answer of minimum norm
    one = ridge_qr(df.filter("g = 9"), ["a", "b"], "y", 0.0).first()["coef"]
    assert np.allclose(one, [0.6, 1.2])
    assert ridge_qr(df.limit(0), ["a", "b"], "y", 0.0).count() == 0
    with pytest.raises(Exception, match="negative weight"):
        ridge_qr(df.withColumn("w", F.lit(-1.0)), ["a", "b"], "y", 0.5, "w").collect()


def test_triangles_merge_like_the_whole():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(100, 4))
    whole = triangle(rows)
    merged = triangle(np.vstack([triangle(rows[:2]), triangle(rows[2:50]), triangle(rows[50:])]))
    assert np.allclose(whole.T @ whole, merged.T @ merged)
    x, y = rows[:, :3], rows[:, 3]
    assert np.allclose(solve_triangle(merged, 0.3), np.linalg.solve(x.T @ x + 0.3 * np.eye(3), x.T @ y))


def test_images_round_trip_with_all_channels(spark, tmpdir_fresh):
    from latentspark.sources.images import encode_images, read_pixels, unreadable_images, write_pixels, written_id
    rng = np.random.default_rng(5)
    cells = [(f"im {k}", x, y, int(rng.integers(-2**31, 2**31))) for k in range(3) for x in range(4) for y in range(5 + k) if (x, y) != (1, 1)]
    df = spark.createDataFrame([*cells, ("im 0", 0, 0, None), (None, 0, 0, 1)], "image_id string, x int, y int, px int")
    write_pixels(df, os.path.join(tmpdir_fresh, "out"))
    folder = os.path.join(tmpdir_fresh, "out", "*")
    assert unreadable_images(spark, folder).count() == 0
    got = {tuple(r) for r in read_pixels(spark, folder).select(F.url_decode(written_id()).alias("i"), "x", "y", "px").collect()}
    assert got == set(cells) | {(f"im {k}", 1, 1, 0) for k in range(3)}
    assert encode_images(df.limit(0)).count() == 0


def test_lines_keep_their_order_across_files(spark, tmpdir_fresh):
    from latentspark.sources.text import read_written_lines, write_lines
    rows = [(a, b, "" if b == 2 else f"line {a} {b}") for a in range(400) for b in range(3)]
    df = spark.createDataFrame(rows, "a int, b int, line string").repartition(6)
    path = os.path.join(tmpdir_fresh, "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_lines(df, path, ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(f for f in os.listdir(path) if f.startswith("part"))
    assert len(files) > 2
    assert "".join(open(os.path.join(path, f)).read() for f in files).split("\n")[:-1] == [r[2] for r in rows]
    got = sorted((r["n"], r["value"]) for r in read_written_lines(spark, path).collect())
    assert got == [(n + 1, r[2]) for n, r in enumerate(rows)]


def test_answers_to_files_in_the_order_of_the_requests(spark, tmpdir_fresh):
    from latentspark.plans.model import FactorModel, write_answers
    uf = spark.createDataFrame([(u, [1.0 + u]) for u in range(3)], "id long, features array<double>")
    vf = spark.createDataFrame([(i, [float(i)]) for i in range(4)], "id long, features array<double>")
    model = FactorModel(uf, vf, spark.createDataFrame([(0, 3)], "user long, item long"), None, {"rank": 1})
    lines = spark.createDataFrame([(0, "2, 9"), (1, "x0"), (2, "2")], "line_id long, value string")
    path = os.path.join(tmpdir_fresh, "answers")
    write_answers(model, lines, path, k=1)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert text == ("Recommendation for user 2:\n    Rank: 9.000   Movie: \n\nRecommendation for user 0:\n    Rank: 2.000   Movie: \n\n"
                    "Recommendation for user 2:\n    Rank: 9.000   Movie: \n\n")
