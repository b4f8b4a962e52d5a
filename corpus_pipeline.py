"""Corpus pipeline: documents → quality rules → near-duplicate groups → personal data → mixing → packed sequences.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from latentspark.llm.common import table
from latentspark.session import cut


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    from latentspark.llm import quality_rules as q
    return q.keep_good(docs, q.learn_rules(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest doc_id."""
    from latentspark.llm.superminhash import keep_one
    return keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become tags in ``text``, ``n_chars`` follows; every document stays."""
    from pyspark.sql import functions as F

    from latentspark.llm import personal_data as p
    clean = p.redact(docs, p.learn_spans(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Target: all of the good domain's tokens and none of the others'.

    Rates go to the nearest whole number of copies, so good documents stay
    once and documents of an unwanted domain go.
    """
    from latentspark.llm import mixing as m
    return m.remix(docs, table(spark, sf_dir, "labels"), {"good": 1.0}, budget_of=("good",), rounding="nearest")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    from latentspark.llm.packing import pack_documents
    return pack_documents(docs)


STAGES = [("quality rules", quality), ("MinHash near-dedup", near_duplicates), ("personal data", personal_data),
          ("mixing to target weights", mixing), ("best-fit packing", packing)]

#: The stages need learned models and tokenizers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
