"""Pairing of completions, predictions, teachers and pictures with their problems, by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import GENERATIONS
from tallymark.operators.skew import exists_join, join_unique, one_per_key

_KNOWN = "__known"


def join_truth(
    completions: DataFrame, truth: DataFrame, key: str = "id", hot: DataFrame | None = None, known_unique: bool = False
) -> DataFrame:
    """Completions with their truth; unmatched rows of either side drop out, doubled truths are an error."""
    return join_unique(
        completions, truth, key, spread=["gen"], hot=hot, known_unique=known_unique, what="ground truth"
    )


def match_truth(
    completions: DataFrame, truth: DataFrame, key: str = "id", hot: DataFrame | None = None, known_unique: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Completions with their truth, and those that have none."""
    known = truth.withColumn(_KNOWN, F.lit(True))
    joined = join_unique(completions, known, key, spread=["gen"], how="left", hot=hot, known_unique=known_unique, what="ground truth")
    return joined.filter(F.col(_KNOWN)).drop(_KNOWN), joined.filter(F.col(_KNOWN).isNull()).select(completions.columns)


def join_predictions(dataset: DataFrame, predictions: DataFrame, key: str = "id") -> DataFrame:
    """Each example with its prediction. Ids are unique on both sides, so no key has many rows."""
    return dataset.join(one_per_key(predictions, key, "prediction"), key)


def join_teacher(samples: DataFrame, teacher: DataFrame, key: str = "id") -> DataFrame:
    """Samples with the teacher's completion where there is one."""
    answers = teacher.select(key, F.col("completion").alias("teacher_completion"))
    return samples.join(one_per_key(answers, key, "teacher"), key, "left")


def with_image(samples: DataFrame, images: DataFrame) -> DataFrame:
    """Samples whose picture exists."""
    return exists_join(samples, images, "image", spread=["id"])


def without_image(samples: DataFrame, images: DataFrame) -> DataFrame:
    """Samples whose picture is missing."""
    return exists_join(samples, images, "image", spread=["id"], missing=True)


def rollout_requests(prompts: DataFrame, generations: int = GENERATIONS) -> DataFrame:
    """One row per prompt and generation, numbered from 0."""
    if generations < 1:
        raise ValueError("at least one generation is needed")
    return prompts.withColumn("gen", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(generations - 1).cast("long"))))
