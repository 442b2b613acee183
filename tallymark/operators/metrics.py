"""Aggregates over graded predictions and prepared samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.equivalence import answer_key, equals_key
from tallymark.functions.text import exact_equal, extract_answer, strip_prompt_prefix

GRADE_FLAGS = ("has_answer", "is_exact", "is_equivalent")


def num_samples() -> Column:
    return F.count(F.lit(1))


def rate(flag: Column) -> Column:
    """Share of all rows for which the flag is true; 0.0 for no rows."""
    return F.coalesce(F.avg(F.when(flag, F.lit(1.0)).otherwise(F.lit(0.0))), F.lit(0.0))


def format_rate(predicted: Column) -> Column:
    return rate(predicted.isNotNull())


def predicted_answers(predictions: DataFrame) -> DataFrame:
    """Generated texts without their prompts, and the answers in them: ``id, prediction, predicted_answer``.

    Meant to run before the join with the examples, where a report then needs only the answers.
    """
    prediction = strip_prompt_prefix(F.col("generated"), F.col("prompt_text"))
    return predictions.select("id", prediction.alias("prediction")).withColumn(
        "predicted_answer", extract_answer(F.col("prediction"))
    )


def gradable() -> Column:
    """Whether a row can be graded: an extracted answer needs a ground truth to meet."""
    return F.col("predicted_answer").isNull() | F.col("ground_truth").isNotNull()


def grade(pairs: DataFrame) -> DataFrame:
    """Add the flags ``has_answer``, ``is_exact`` and ``is_equivalent`` to gradable pairs."""
    predicted, truth = F.col("predicted_answer"), F.col("ground_truth")
    answered = predicted.isNotNull()
    return (
        pairs.withColumn("truth_key", answer_key(truth))
        .withColumns(
            {
                "has_answer": answered,
                "is_exact": F.coalesce(exact_equal(predicted, truth), F.lit(False)),
                "is_equivalent": F.coalesce(equals_key(predicted, F.col("truth_key")), F.lit(False)),
            }
        )
        .drop("truth_key")
    )


def eval_row(graded: DataFrame) -> DataFrame:
    """Project to the row kept for every graded prediction."""
    return graded.select("id", "prediction", "predicted_answer", "ground_truth")


def eval_report(graded: DataFrame, *by: str) -> DataFrame:
    """One summary row, or one per run with ``by``."""
    measures = (
        num_samples().alias("num_samples"),
        rate(F.col("has_answer")).alias("format_rate"),
        rate(F.col("is_exact")).alias("exact_match"),
        rate(F.col("is_equivalent")).alias("symbolic_accuracy"),
    )
    return graded.groupBy(*by).agg(*measures) if by else graded.agg(*measures)


def prep_summary(classified: DataFrame) -> DataFrame:
    """Problems, samples, pictures and rejects per split, from ``split`` and ``reason``."""
    return classified.groupBy("split").agg(
        F.count(F.lit(1)).alias("problems"),
        F.count_if(F.col("reason").isNull()).alias("samples"),
        F.count_if(F.col("reason").isNull()).alias("images"),
        F.count_if(F.col("reason") == "no_image").alias("no_image"),
        F.count_if(F.col("reason") == "bad_image").alias("bad_image"),
    )
