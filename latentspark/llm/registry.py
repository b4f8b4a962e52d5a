"""Queries of this subpackage, one per operator, with their DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from latentspark.llm.common import table


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision list learned from ``labels``, applied to every whole text of ``documents``."""
    from latentspark.llm import quality_rules as q
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = q.learn_rules(docs, table(spark, sf_dir, "labels"))
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return q.judge(docs, rules, "s").select("doc_id", *[F.col(f"s.{f}").alias(f) for f in fields])


def op10_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every whole document."""
    from latentspark.llm.superminhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data spans of every whole document."""
    from latentspark.llm import personal_data as p
    docs = table(spark, sf_dir, "documents")
    return p.span_report(docs, p.learn_spans(docs))


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors, rate and copies of every document under the default target weights."""
    from latentspark.llm import mixing as m
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = m.mix(docs, table(spark, sf_dir, "labels"), m.WEIGHTS, "m", keep=("doc_id",))
    return mixed.select("doc_id", "m.n_tokens", *[(F.col("m.q")[i] / float(m.GRID)).alias(f"p_{d}") for i, d in enumerate(m.DOMAINS)],
                        "m.rate", "m.copies")


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without those of 100-byte strings that start earlier."""
    from latentspark.llm.repeats import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op3_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every whole document under the count baseline and the recurrent class model."""
    from latentspark.llm.gated_lm import score_documents
    return score_documents(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    from latentspark.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


def op6_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -7: rendered, read back, digested."""
    from latentspark.llm import chat as c
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return c.digests(c.read_back(c.render(c.fold_events(c.events_of(rows.union(c.planted(spark)))))))


def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to dictionary-compressed archives and read back."""
    from latentspark.llm.warc import round_trip
    return round_trip(spark, table(spark, sf_dir, "pages"))


def op5_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50, among all others."""
    from latentspark.llm.forest import nearest
    return nearest(table(spark, sf_dir, "embeddings"))


def op11_hyperplane_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive of ``embeddings``; ids divisible by 7 carry the next label."""
    from latentspark.llm.hard_negatives import mine
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id").cast("long") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(table(spark, sf_dir, "embeddings"), label)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole document, of which one in ten is made periodic first."""
    from latentspark.llm import periodic_runs as p
    docs = table(spark, sf_dir, "documents").select("doc_id", p.planted_text(F.col("doc_id"), F.col("text")).alias("text"))
    return p.run_digests(p.find_runs(docs, into="periodic"), "periodic")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned from those that are not held out."""
    from latentspark.llm import language as g
    docs = table(spark, sf_dir, "documents")
    model = g.fit_languages(docs.filter(g.learnable(F.col("doc_id"))))
    found = g.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", g.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


QUERIES = {"op1_soft_mixing": op1_soft_mixing, "op2_suffix_repeats": op2_suffix_repeats,
           "op3_gated_lm": op3_gated_lm,
           "op4_best_fit_packing": op4_best_fit_packing,
           "op5_projection_forest": op5_projection_forest, "op6_chat_events": op6_chat_events,
           "op7_quality_rules": op7_quality_rules, "op8_personal_data": op8_personal_data,
           "op9_warc_dictionary": op9_warc_dictionary, "op10_superminhash": op10_superminhash,
           "op11_hyperplane_negatives": op11_hyperplane_negatives, "op12_periodic_runs": op12_periodic_runs,
           "op13_language": op13_language}

ORACLE_SQL: dict[str, str] = {
    "op11_hyperplane_negatives": """
        WITH parts AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, len(embedding) AS d
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        size AS (SELECT d FROM parts GROUP BY d ORDER BY count(*) DESC, d LIMIT 1),
        x AS (SELECT vec_id, label, v FROM parts WHERE d = (SELECT d FROM size)),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   list_inner_product(a.v, b.v)::BIGINT AS score
            FROM x a JOIN x b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT * FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, p.other_id AS positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
               n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND n.score <= p.score
        QUALIFY rank <= 5"""}
