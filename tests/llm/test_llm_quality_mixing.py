"""Quality rules and mixing against plain Python versions, and their edge cases."""

import re

import numpy as np
from pyspark.sql import functions as F

from latentspark.llm import mixing as m, quality_rules as q


def plain_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


TEXTS = [None, "", " \t\n", "a", "a b c a b c", "x x x x x", "é ü ##|| <b>", "l\nl\n\nl \nl", "a b c\nA b c\na b c d",
         "wort " * 60, " ".join(f"w{i}" for i in range(70)), "日本 " * 3 + "| $$ %", "a\x0bb\x0cc\rd", "z" * 30_000]


def test_statistics_of_hard_texts():
    for t in TEXTS:
        assert q.count_text(t)[:5] == plain_statistics(t), t


def test_verdict_columns_and_clashing_names(spark):
    rows = [(i, t, f"own{i}") for i, t in enumerate(TEXTS)] + [(3, "a", "own3"), (None, "a b", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality_stats string")
    rule = q.Rule((("symbols_per_word", True, 0.2),), 1.0, 9)
    kept = q.keep_good(docs, [rule])
    assert kept.columns == docs.columns
    assert [r["quality_stats"] for r in kept.collect()] == ["own10"]  # the only long text without repeats


def test_no_labels_no_rules(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for labels in ([], [(1, None)], [(9, 0)]):
        assert q.learn_rules(docs, spark.createDataFrame(labels, "doc_id long, quality int")) == []
    assert q.judge(docs.limit(0), [], "s").count() == 0


def test_learned_rules_separate_planted_junk(spark):
    rng = np.random.default_rng(1)
    def text(i):
        words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(80)]
        return " ".join(w + "%%%" if i % 4 == 0 else w for w in words)
    rows = [(i, text(i)) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 240)], "doc_id long, quality int")
    rules = q.learn_rules(docs, labels.filter("doc_id < 160"))
    assert rules and all(r.precision >= 0.95 for r in rules)
    kept = {r["doc_id"] for r in q.keep_good(docs, rules).collect()}
    held_out = [i for i in range(160, 240)]
    assert np.mean([(i in kept) == (i % 4 != 0) for i in held_out]) == 1.0


def test_cover_prunes_noise():
    rng = np.random.default_rng(0)
    x = rng.random((600, 3))
    bad = (x[:, 0] > 0.7) & (x[:, 1] <= 0.5)
    rules = q.cover(x, bad, ["a", "b", "c"], min_precision=0.9)
    hit = np.any([r.covers(x, ["a", "b", "c"]) for r in rules], axis=0)
    assert (hit & bad).sum() >= 0.9 * bad.sum() and (hit & ~bad).sum() <= 0.05 * bad.sum()


def test_projected_gradient_meets_targets_like_a_dense_solver(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    qs = np.rint(p * m.GRID).astype(int)
    qs[:, 0] += m.GRID - qs.sum(1)
    tokens = rng.integers(1, 500, 400)
    df = spark.createDataFrame([(i, {"n_tokens": int(t), "q": [int(v) for v in r]}) for i, (t, r) in enumerate(zip(tokens, qs))],
                               "doc_id long, mix struct<n_tokens:bigint,q:array<int>>")
    for weights in ({"good": 0.6, "poor": 0.3, "toxic": 0.1}, {"good": 0.9, "poor": 0.07, "toxic": 0.03}):
        rates = m.fit_rates(df, "mix", weights)
        assert rates.converged
        r = m.rates_of(qs / m.GRID, rates.history)
        assert (r >= 0).all()
        reached = (r * tokens) @ (qs / m.GRID)
        assert np.allclose(reached, rates.reached, rtol=1e-9)
        # no nonnegative step along the projected gradient helps: first-order optimality
        have = tokens @ (qs / m.GRID)
        scale = 1 / ((qs / m.GRID) ** 2 * tokens[:, None]).sum(0)
        g = (qs / m.GRID) @ (scale * (reached - np.array(rates.targets)))
        size = np.abs(scale * have).max()
        assert (np.abs(g[r > 1e-6]) < 1e-3 * size).all() and (g[r <= 1e-6] > -1e-3 * size).all()
        if weights["good"] == 0.6:
            assert np.allclose(reached / reached.sum(), [0.6, 0.3, 0.1], atol=1e-3)


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "a b", 7), (None, "c", 8)], "doc_id long, text string, mix int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = m.remix(docs, none, {"good": 1.0}, rounding="nearest")
    assert out.columns == docs.columns and out.count() == 4  # all of the first domain, rate 1
    nulls = spark.createDataFrame([(1, None, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    assert m.mix(docs.select("doc_id", "text"), nulls, into="m", keep=("doc_id",)).count() == 4
    assert m.remix(docs.limit(0), none, {"good": 1.0}).count() == 0


def test_copies_follow_rates_in_expectation(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.struct(F.lit(10).cast("long").alias("n_tokens"),
                                                                        F.array(F.lit(1000), F.lit(0), F.lit(0)).alias("q")).alias("mix"))
    rates = m.Rates([[0.4, 0.0, 0.0, 0.0]], [], [], True)
    out = m.with_rates(df, "mix", rates).agg(F.avg("mix.copies"), F.max("mix.copies")).first()
    assert abs(out[0] - 0.6) < 0.02 and out[1] == 1


def test_toxic_documents_are_told_apart(spark):
    rng = np.random.default_rng(3)
    def text(i):
        w = ["".join(rng.choice(list("abcd"), 3)) for _ in range(40)]
        return " ".join(w + (["Vile,", "awful"] if i % 3 == 0 else []))
    docs = spark.createDataFrame([(i, text(i)) for i in range(300)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in m.remix(docs, labels, {"good": 1.0}, budget_of=("good",), rounding="nearest").collect()}
    assert kept == {i for i in range(300) if i % 3}
