"""Language identification: n-grams, the learner, calibration, held-out accuracy, edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from latentspark.llm import language as g

SF = "/root/testdata/sf0.01"


def test_grams_see_letters_only():
    assert not len(g.grams(None)) and not len(g.grams("")) and not len(g.grams("12 --- \n 7"))
    assert np.array_equal(g.grams("Ab  c"), g.grams("ab, \n9 C!"))
    assert not np.array_equal(g.grams("ab c"), g.grams("a bc"))
    # 4 letters with a space at both ends: 6 + 5 + 4 + 3 n-grams
    assert len(g.grams("über")) == 18
    at, w = g.term_weights(np.array([7, 3, 7, 7], dtype=np.uint16))
    assert at.tolist() == [3, 7] and np.allclose(w, [1, 1 + np.log(3)])


def test_document_frequencies_equal_brute_force(spark):
    texts = ["ab ab", "ab", None, "12", "ba " * 50]
    n, df = g.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    want = np.zeros(g.BUCKETS, dtype=int)
    for t in texts:
        want[np.unique(g.grams(t))] += 1
    assert n == 3 and np.array_equal(df, want)


def test_elastic_net_leaves_noise_at_zero():
    rng = np.random.default_rng(1)
    leader = g.FollowTheLeader(41, 2, l1=20.0)
    for _ in range(200):
        y = rng.integers(0, 2, 16)
        x = rng.normal(0, 1, (16, 40))
        x[:, 0] += 3 * (2 * y - 1)
        leader.learn(np.arange(40), x, np.eye(2)[y])
    w = leader.weights()
    assert w[0, 1] > 0 > w[0, 0] and (w[1:40] == 0).mean() > 0.9


def test_temperature_recovers_overconfidence():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 2, (4000, 3))
    y = np.array([rng.choice(3, p=p) for p in g.softmax(z)])
    assert abs(g.fit_temperature(z * 5, y) - 5) < 0.6
    assert g.fit_temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, None, "en"), (4, "", "en"),
                                  (5, "123 !!", "de"), (None, "the bird", "xx"), (6, "the cow", None), (2, "the dog and the cat", "en")],
                                 "doc_id long, text string, lang string").withColumn("language", F.lit("own"))
    model = g.fit_languages(docs, per_language=10)
    assert model.names == ["de", "en"]
    got = g.identify(docs, model, into="l2").select("doc_id", "text", "language", "l2.*").collect()
    assert len(got) == 8 and {r["language"] for r in got} == {"own"}
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang"] in model.names) == letters and (r["lang"] == "und") == (not letters) and 0 <= r["score"] <= 1
    one = g.fit_languages(docs.filter("lang = 'de'"))
    assert one.judge("whatever") == ("de", 1.0) and one.judge(None) == ("und", 0.0)
    none = g.fit_languages(docs.limit(0))
    assert none.judge("the dog") == ("und", 0.0)
    assert g.identify(docs.drop("language").limit(0), model).count() == 0


def test_held_out_accuracy_and_calibration(spark):
    from latentspark.llm.registry import op13_language
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = op13_language(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    right = np.array([r["lang_pred"] == truth[r["doc_id"]] for r in held])
    assert right.mean() > 0.98
    assert abs(right.mean() - np.mean([r["score"] for r in held])) < 0.02


def test_lang_of_the_judged_rows_is_not_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").filter("doc_id < 200")
    model = g.fit_languages(docs.filter(g.learnable(F.col("doc_id"))), per_language=50)
    a = g.identify(docs, model).select("doc_id", "language").collect()
    b = g.identify(docs.withColumn("lang", F.lit("zz")), model).select("doc_id", "language").collect()
    assert sorted(a) == sorted(b)
