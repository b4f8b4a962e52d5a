"""The pipeline stage by stage on the small table."""

import corpus_pipeline
from pyspark.sql import functions as F

from latentspark.llm import superminhash
from latentspark.llm.common import table
from latentspark.session import cut

from conftest import SF001


def test_stages_take_effect(spark):
    docs = table(spark, SF001, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, docs, SF001))
        assert after.columns == columns, name
        seen[name] = (docs, after)
        docs = after
    before, after = seen["quality rules"]
    labels = table(spark, SF001, "labels").join(before.select("doc_id", "text"), "doc_id")
    kept = {r["doc_id"] for r in after.collect()}
    long = labels.filter(F.size(F.split("text", r"[\x20\x09-\x0D]+")) > 60).collect()
    assert all(r["doc_id"] in kept for r in long if r["quality"] == 1 and r["toxic"] == 0 and "%%%" not in r["text"])
    assert not any(r["doc_id"] in kept for r in long if r["quality"] == 0 and r["text"].count("%%%") > 10)
    before, after = seen["MinHash near-dedup"]
    groups = {r["doc_id"]: r["component_id"] for r in superminhash.near_duplicates(before).collect()}
    assert {r["doc_id"] for r in after.collect()} == set(groups.values())
    before, after = seen["personal data"]
    assert after.count() == before.count()
    assert after.filter(F.col("text").rlike(r"[a-z]\.[0-9]+@mail")).count() == 0
    assert after.filter(F.length("text") != F.col("n_chars")).count() == 0
    before, after = seen["mixing to target weights"]
    assert after.join(before, "doc_id", "left_anti").count() == 0
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert placed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def _folder(spark, tmp, docs):
    path = f"{tmp}/sf"
    docs.write.parquet(f"{path}/documents.parquet")
    table(spark, SF001, "labels").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_on_nulls_repeats_long_texts_and_clashing_columns(spark, tmpdir_fresh):
    base = table(spark, SF001, "documents")
    letters = str.maketrans("0123456789", "abcdefghij")
    clean = " ".join(f"word{i} and{i * 7} the{i * 13}".translate(letters) for i in range(60))
    very_long = " ".join(f"w{i}x{(i * 7919) % 10_007}".translate(letters) for i in range(20_000))
    hard = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, clean + " alpha", None, "s", 5), (9003, clean + " beta gamma delta epsilon zeta", "en", "s", 9),
         (9003, clean + " beta gamma delta epsilon zeta", "en", "s", 9), (9004, very_long, "en", "s", len(very_long)), (9005, " \t\n", "en", None, 3)], base.schema)
    extra = ("deal", "s", "mix", "quality_stats", "label_id", "domain", "words", "key", "kept", "component_id", "spans", "d")
    docs = base.unionByName(hard).select("*", *[F.concat(F.lit(f"{c}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in extra])
    path = _folder(spark, tmpdir_fresh, docs)
    docs = table(spark, path, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, path))
        assert docs.columns == columns, name
        rows = docs.select("doc_id", "text", *extra).collect()
        # further columns keep their values and stay with their rows
        assert all(r[c] == f"{c}-{'none' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in extra), name
        ids = [r["doc_id"] for r in rows]
        assert set(ids) <= {r["doc_id"] for r in before.select("doc_id").collect()}, name
        if name == "quality rules":
            # no words: rejected by the base rule; the clean ones stay, repeated rows each on its own
            assert not {9001, 9002, 9005} & set(ids) and ids.count(9003) == 2 and {None, 9004} <= set(ids)
        if name == "MinHash near-dedup":
            assert ids.count(9003) + ids.count(None) >= 1 and 9004 in ids
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert placed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert placed.filter("doc_id = 9004").count() > 1 or docs.filter("doc_id = 9004").count() == 0


def test_stages_on_empty_tables(spark, tmpdir_fresh):
    path = _folder(spark, tmpdir_fresh, table(spark, SF001, "documents").limit(0))
    docs = table(spark, path, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut(stage(spark, docs, path))
        assert after.columns == docs.columns and after.count() == 0, name
        docs = after
    assert corpus_pipeline.run(spark, path).count() == 0
