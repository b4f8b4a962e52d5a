import os

import pytest
from pyspark.sql import functions as F

from latentspark.operators.ratings import dedupe_ratings, dims, pad_factors, rated_items
from latentspark.sources.text import parse_requests, read_items, read_lines, read_ratings


def _write(path, text, enc="utf-8"):
    with open(path, "w", encoding=enc, newline="") as f:
        f.write(text)


def test_rating_lines_quirks(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "u.data")
    _write(p, "1\t2\t5\t881250949\n"       # good line (time ignored)
              "3\t4\n"                      # two fields: dropped
              "5\t6\t\n"                    # trailing tab after two fields: dropped (Q12)
              "7 8 3\n")                    # single spaces
    got = sorted((r["user"], r["item"], r["rating"]) for r in read_ratings(spark, p).orderBy("ord").collect())
    assert got == [(0, 1, 5.0), (6, 7, 3.0)]


def test_empty_field_fails_in_failfast_and_drops_in_dropmalformed(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "bad.data")
    _write(p, "1  2 3\n2 3 4\n")            # two spaces in a row → empty field
    with pytest.raises(Exception):
        read_ratings(spark, p).collect()
    assert [tuple(r)[:3] for r in read_ratings(spark, p, mode="dropmalformed").collect()] == [(1, 2, 4.0)]


def test_duplicate_pair_last_line_wins(spark):
    lines = spark.createDataFrame([(0, 1, 4.0, 1), (0, 1, 2.0, 2), (1, 1, 3.0, 1)],
                                  "user int, item int, rating double, ord long")
    got = {(r["user"], r["item"]): r["rating"] for r in dedupe_ratings(lines).collect()}
    assert got == {(0, 1): 2.0, (1, 1): 3.0}


def test_title_lines_latin1(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "u.item")
    _write(p, "1|Café Noir (1995)|01-Jan-1995||http://x\n"
              "2|He said \"no\" (1996)|x\n"
              "3|\n"                                  # id only: dropped
              "40|Unrated film|x\n", enc="ISO-8859-1")
    got = {r["item"]: r["name"] for r in read_items(spark, p).collect()}
    assert got == {0: "Café Noir (1995)", 1: 'He said "no" (1996)', 39: "Unrated film"}
    assert read_lines(spark, p).count() == 4


def test_parse_requests_order_and_repeats(spark):
    lines = spark.createDataFrame([(0, "1, 7"), (1, " 3, 3 x 99999999999 99999999999999999999"), (2, "")], "lid int, value string")
    got = [(r["line_id"], r["pos"], r["user"]) for r in parse_requests(lines, "lid").orderBy("line_id", "pos").collect()]
    # leading blank accepted, repeated id kept, wide ids kept, a number beyond BIGINT dropped, empty line gives nothing
    assert got == [(0, 0, 1), (0, 1, 7), (1, 0, 3), (1, 1, 3), (1, 2, 99999999999)]


def test_dims_rated_items_pad(spark):
    r = spark.createDataFrame([(0, 2, 1.0), (0, 0, 2.0), (2, 1, 3.0), (0, 2, 5.0)], "user int, item int, rating double")
    d = dims(r)
    assert (d.n_users, d.n_items, d.n_ratings) == (3, 3, 4)
    assert {x["user"]: x["items"] for x in rated_items(r).collect()} == {0: [0, 2], 2: [1]}
    chunks = {(x["user"], x["chunk"]): x["items"] for x in rated_items(r, chunk=2).collect()}
    assert chunks == {(0, 0): [0], (0, 1): [2], (2, 0): [1]}
    f = spark.createDataFrame([(1, [1.0, 2.0]), (3, [3.0, 4.0])], "id int, features array<double>")
    got = {x["id"]: x["features"] for x in pad_factors(f, 4, 2).collect()}
    # missing ids 0 and 2 are filled over 0..n-1 (Q2)
    assert got == {0: [0.0, 0.0], 1: [1.0, 2.0], 2: [0.0, 0.0], 3: [3.0, 4.0]}


def test_synthetic_low_rank_is_low_rank(spark):
    import numpy as np
    from latentspark.sources.synthetic import low_rank_ratings
    r = low_rank_ratings(spark, 8, 9, 2, density=1.0, seed=3).toPandas()
    Y = r.pivot(index="user", columns="item", values="rating").to_numpy()
    assert Y.shape == (8, 9)
    assert np.linalg.matrix_rank(Y, tol=1e-8) == 2
    part = low_rank_ratings(spark, 20, 20, 2, density=0.5, seed=3).count()
    assert 100 < part < 300
