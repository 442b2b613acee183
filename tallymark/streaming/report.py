"""A report over predictions as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallymark.operators.joins import match_truth
from tallymark.operators.metrics import GRADE_FLAGS, gradable, grade, predicted_answers
from tallymark.operators.skew import hot_keys, one_per_key
from tallymark.schemas import PREDICTION
from tallymark.sources.tables import parse_jsonl, split_bad_lines
from tallymark.storage import materialize, scratch
from tallymark.streaming.score import line_stream

RUN_PREDICTION = T.StructType([T.StructField("run", T.StringType()), *PREDICTION.fields])
REJECTS = ("bad_lines", "no_example", "no_ground_truth")


def batch_counts(lines: DataFrame, truths: DataFrame) -> DataFrame:
    """Of JSON lines with predictions the counts per run: graded ones, those with each flag, and rejects.

    Bad lines belong to no run. ``truths`` are unique, as :func:`report_stream` prepares them.
    """
    parsed = parse_jsonl(lines, RUN_PREDICTION, "keep", required=("run", "id"))
    answers = predicted_answers(parsed.withColumn("id", F.struct("id", "run", "bad_line")))
    reduced = materialize(answers.select("id.*", "predicted_answer"))
    good, bad = split_bad_lines(reduced)
    numbered = good.withColumn("gen", F.monotonically_increasing_id())
    matched, unmatched = match_truth(numbered, truths, hot=materialize(hot_keys(good, "id")), known_unique=True)
    graded = grade(matched).withColumn("gradable", gradable())
    flags = [F.count_if(F.col("gradable") & F.col(flag)).alias(flag) for flag in GRADE_FLAGS]
    counts = graded.groupBy("run").agg(
        F.count_if("gradable").alias("num_samples"), *flags, F.count_if(~F.col("gradable")).alias("no_ground_truth")
    )
    lost = unmatched.groupBy("run").agg(F.count(F.lit(1)).alias("no_example"))
    broken = bad.agg(F.count(F.lit(1)).alias("bad_lines")).select(F.lit(None).cast("string").alias("run"), "bad_lines")
    return counts.unionByName(lost, True).unionByName(broken, True).na.fill(0)


def report_stream(
    spark: SparkSession, source: str, dataset: DataFrame, ledger: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Grade the JSON lines (run, id, prompt_text, generated) of new files in ``source`` and add them to a ledger, then stop.

    The ledger has the counts of each micro-batch in a folder of its own, which a repeated batch replaces, so that nothing
    counts twice; :func:`running_report` adds them up. ``dataset`` has id and ground_truth.
    """
    truths = materialize(one_per_key(dataset.select("id", "ground_truth"), "id", "example"))

    def count(lines: DataFrame, number: int) -> None:
        with scratch(spark):
            batch_counts(lines, truths).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    arriving = line_stream(spark, source, files_per_batch)
    return arriving.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_report(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per run, as :func:`tallymark.operators.metrics.eval_report` gives of all predictions that were graded so far."""
    counts = ("num_samples", *GRADE_FLAGS)
    totals = spark.read.parquet(ledger).filter("run IS NOT NULL").groupBy("run").agg(*[F.sum(c).alias(c) for c in counts])
    names = dict(zip(GRADE_FLAGS, ("format_rate", "exact_match", "symbolic_accuracy")))
    rates = [
        F.when(F.col("num_samples") > 0, F.col(flag) / F.col("num_samples")).otherwise(F.lit(0.0)).alias(name)
        for flag, name in names.items()
    ]
    return totals.select("run", "num_samples", *rates)


def running_rejects(spark: SparkSession, ledger: str) -> DataFrame:
    """Per run (none for bad lines) how many lines could not be graded, and why."""
    return spark.read.parquet(ledger).groupBy("run").agg(*[F.sum(c).alias(c) for c in REJECTS])
