"""A pipeline over the documents: each stage takes what its predecessor kept; all but the last return its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import decontaminate, minhash, packing, secrets, toxicity
from tallymark.llm.common import materialize, table


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half, learnt from the labels of those that aren't held out."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest id."""
    return minhash.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of ten words of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and their characters counted again."""
    found = secrets.redact(docs)
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", not_toxic),
    ("near copies", distinct),
    ("decontamination", decontaminated),
    ("secrets", redacted),
    ("packing", packed),
]

#: Tokens, neighbours and signatures are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
