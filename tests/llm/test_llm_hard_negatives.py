"""Hard negatives against brute force: random, clustered, repeated and degenerate vectors; the tree prunes where it can."""

import math

import numpy as np
from pyspark.sql import functions as F

from latentspark.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5):
    x = {}
    sizes = {}
    for i, e, l in rows:
        if i is None or l is None or e is None or not len(e) or any(c is None or not math.isfinite(c) for c in e):
            continue
        sizes[len(e)] = sizes.get(len(e), 0) + 1
        row = (l, [math.floor(256 * float(np.float32(c))) for c in e])
        x.setdefault(i, []).append(row)
    d = min(sizes, key=lambda s: (-sizes[s], s)) if sizes else 0
    x = {i: min(r for r in v if len(r[1]) == d) for i, v in x.items() if any(len(r[1]) == d for r in v)}
    out = set()
    for a, (la, va) in x.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(va, v)), i, l) for i, (l, v) in x.items() if i != a)
        for s, p in [(-s, i) for s, i, l in scored if l == la][:k]:
            fits = [(n, i) for n, i, l in scored if l != la and 80 * s <= -100 * n <= 100 * s][:k]
            out |= {(a, p, r + 1, i, s, -n) for r, (n, i) in enumerate(fits)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, None if e is None else [None if c is None else float(c) for c in e], l) for i, e, l in rows], SCHEMA)
    got = h.mine(df.withColumn("anchor_id", F.lit("own")), F.col("label"), **options).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def test_random_clustered_and_repeated_vectors(spark):
    rng = np.random.default_rng(2)
    loose = [(i, rng.normal(0, 0.2, 8), int(rng.integers(3))) for i in range(300)]
    centres = rng.normal(0, 1, (6, 8))
    tight = [(i, centres[i % 6] + rng.normal(0, 0.02, 8), int(rng.integers(2))) for i in range(400)]
    same = [(i, [0.5, 0.5] if i % 3 else rng.normal(0, 1, 2), i % 4) for i in range(300)]
    for rows in (loose, tight, same):
        for options in ({}, {"leaf_size": 8, "branches": 4, "sample_rows": 100, "leaf_rows": 50}):
            assert mined(spark, rows, every=20, **options) == brute(rows, every=20)


def test_edge_rows(spark):
    rows = [(0, [1, 0], 1), (0, [1, 0], 1), (0, [0.5, 0], 1), (1, [1, 0], 1), (2, [1, 0], 2), (3, [1, 0], 2), (4, [0.9, 0.1], 3),
            (5, None, 1), (6, [], 1), (7, [float("nan"), 1], 1), (8, [float("inf"), 1], 1), (9, [None, 1], 1), (10, [1, 0], None),
            (None, [1, 0], 1), (11, [1, 0, 0], 1), (100, [0, 0], 1), (200, [-1, 0], 7), (300, [-1, 0.1], 7), (-100, [1, 0], 9)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == set()
    assert mined(spark, [(0, [1.0], 1)]) == set()
    assert mined(spark, [(0, None, 1)]) == set()


def test_distance_ranges_eliminate_cells():
    rng = np.random.default_rng(3)
    x = np.floor(256 * (np.repeat(rng.normal(0, 1, (16, 12)), 60, axis=0) + rng.normal(0, 0.02, (960, 12))))
    radius2 = float((x * x).sum(axis=1).max())
    nodes, n = h.fit_tree(x, radius2, 8, 64)
    ranges = [(np.full((len(m.children),) * 2, np.inf), np.full((len(m.children),) * 2, -np.inf)) for m in nodes]
    leaf = h.file_rows(nodes, x, h.added(x, radius2), ranges)
    for m, (low, high) in zip(nodes, ranges):
        m.low, m.high = low, high
    q = x[::60]
    scores = q @ x.T
    low, high = 0.9 * scores.max(axis=1), scores.max(axis=1)
    distance = lambda s: np.sqrt(np.maximum((q * q).sum(axis=1) + radius2 - 2 * s, 0))
    met = h.leaves_met(nodes, n, q, distance(high), distance(low))
    inside = (scores >= low[:, None]) & (scores <= high[:, None])
    for a, c in zip(*np.nonzero(inside)):
        assert met[a, leaf[c]]
    assert met.mean() < 0.5


def test_table_equals_brute_force(spark):
    from latentspark.llm.registry import op11_hyperplane_negatives
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert set(map(tuple, op11_hyperplane_negatives(spark, sf).collect())) == brute(rows)
