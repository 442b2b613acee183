"""What the classifiers share: which rows they may learn from, and a bounded sample of those."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fold, materialize

# Labelled rows of a class that a classifier is fitted on, at most about; which ones is decided by a hash of the id.
PER_CLASS = 4_096
FOLDS = 5
_STEPS = 1 << 30


def held_out(folds: int = FOLDS, out: int = 0) -> Column:
    """Whether a row may not be learnt from."""
    return fold("doc_id", folds) == out


def sampled(rows: DataFrame, kind: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """About ``per_class`` rows of each value of ``kind`` at most, with ``share``: the part of its class that was taken."""
    counts = materialize(rows.groupBy(kind).agg(F.count(F.lit(1)).alias("__n")))
    share = F.least(F.lit(1.0), F.lit(float(per_class)) / F.col("__n"))
    met = rows.join(counts, kind).withColumn("share", share).drop("__n")
    return met.filter(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(_STEPS)) < F.col("share") * _STEPS)


def labelled(docs: DataFrame, labels: DataFrame, target: str, per_class: int = PER_CLASS, folds: int = FOLDS) -> DataFrame:
    """doc_id, target (0 or 1), share: the rows to learn from. A document that is labelled twice has its largest label."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("target"))
    known = known.filter(F.col("target").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(folds))
    known = known.groupBy("doc_id").agg(F.max("target").alias("target"))
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return materialize(sampled(materialize(known.join(there, "doc_id", "left_semi")), "target", per_class))
