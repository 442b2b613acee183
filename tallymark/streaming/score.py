"""Scoring of completions as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallymark.functions.rewards import DEFAULT_REWARDS, Reward, completion_parts, score_parts
from tallymark.functions.text import completion_text
from tallymark.operators.joins import match_truth
from tallymark.operators.skew import hot_keys, one_per_key
from tallymark.plans.grade import reduced_truths
from tallymark.schemas import COMPLETION
from tallymark.sources.tables import parse_jsonl, split_bad_lines
from tallymark.storage import materialize, scratch


def line_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of text files that appear in a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.text(folder)


def score_lines(
    lines: DataFrame, truths: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS, schema: T.StructType = COMPLETION
) -> tuple[DataFrame, DataFrame]:
    """Scored rows of JSON lines with completions, and rejects: bad lines and completions without a problem.

    Every line is in one of the two. ``truths`` are unique, as :func:`score_stream` prepares them.
    """
    # Parsed once: what is written has the parts of good lines and the whole of bad ones.
    parsed = parse_jsonl(lines, schema, "keep")
    parts = completion_parts(rewards, completion_text(parsed))
    good, bad = split_bad_lines(materialize(parsed.select("id", "gen", *parts, "bad_line")))
    matched, unmatched = match_truth(good, truths, hot=materialize(hot_keys(good, "id")), known_unique=True)
    empty = F.lit(None).cast("string")
    rejects = unmatched.select("id", "gen", F.lit("no_problem").alias("reason"), empty.alias("line")).unionByName(
        bad.select(
            empty.alias("id"), F.lit(None).cast("long").alias("gen"), F.lit("bad_line").alias("reason"), F.col("bad_line").alias("line")
        )
    )
    return score_parts(matched, rewards), rejects


def score_stream(
    spark: SparkSession,
    source: str,
    problems: DataFrame,
    target: str,
    checkpoint: str,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    files_per_batch: int | None = None,
    schema: T.StructType = COMPLETION,
    rejects: str | None = None,
) -> StreamingQuery:
    """Score the JSON lines of new files in ``source``, then stop.

    The parser and the expressions are those of the batch: a completion may be text, messages, chunks or
    VARIANT, as ``schema`` says. Each micro-batch is a folder ``batch=N`` of the tables ``target`` and
    ``rejects`` (by default beside it), which it replaces if it has to run again. Hot keys are found
    within the micro-batch, so that earlier files are never read again.
    """
    truths = materialize(one_per_key(reduced_truths(problems, rewards), "id", "ground truth"))
    rejects = rejects or f"{target.rstrip('/')}_rejects"

    def score(lines: DataFrame, number: int) -> None:
        with scratch(spark):
            scored, rejected = score_lines(lines, truths, rewards, schema)
            scored.write.mode("overwrite").parquet(f"{target}/batch={number}")
            rejected.write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    arriving = line_stream(spark, source, files_per_batch)
    return arriving.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
