"""From predictions to a report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import EVAL_SAMPLES
from tallymark.operators.index import first_rows
from tallymark.operators.joins import join_predictions, match_truth
from tallymark.operators.metrics import GRADE_FLAGS, eval_report, gradable, grade, predicted_answers
from tallymark.operators.samples import sample_number
from tallymark.operators.skew import one_per_key
from tallymark.schemas import EVAL_ROW
from tallymark.sources.sinks import report_rows, write_eval_samples, write_report
from tallymark.storage import materialize

_ANSWERED = "__answered"


@dataclass(frozen=True)
class Evaluation:
    """Summary, graded samples with their flags, and the pairs that could not be graded."""

    model: str
    report: DataFrame
    samples: DataFrame
    rejects: DataFrame

    def write(self, folder: str) -> str:
        """Write samples and summary below ``folder`` and return the path of the summary.

        The summary is taken from the written samples, so that nothing is graded twice.
        """
        run = self.model.rstrip("/").split("/")[-1]
        written = write_eval_samples(self.samples, f"{folder.rstrip('/')}/samples", run)
        graded = self.samples.sparkSession.read.parquet(written)
        return write_report(eval_report(graded), folder, self.model)


def graded_predictions(dataset: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each example with its prediction, as ``id, ground_truth, prediction, predicted_answer``."""
    return join_predictions(dataset.select("id", "ground_truth"), predicted_answers(predictions))


def evaluate(
    dataset: DataFrame,
    predictions: DataFrame,
    model: str,
    max_samples: int | None = EVAL_SAMPLES,
    order: str | None = None,
) -> Evaluation:
    """Grade predictions for the first ``max_samples`` examples; 0 or None takes all.

    Examples without a prediction and answers without a ground truth are rejects with a reason.

    ``dataset`` has ``id, ground_truth`` and is in the order of the column ``order``, by default of
    the numbers in its ids (ids without a number need an ``order``); ``predictions`` has ``id, prompt_text, generated``.
    """
    position = F.col(order) if order else sample_number(F.col("id"))
    examples = dataset.select("id", "ground_truth", position.alias("position"))
    if max_samples:
        examples = materialize(first_rows(examples, max_samples, "position"))
        # Leave out the predictions for all other examples before anything is shuffled.
        predictions = predictions.join(examples.select("id"), "id", "left_semi")
    answers = predicted_answers(predictions)
    answered = answers.select("id", "predicted_answer").withColumn(_ANSWERED, F.lit(True))
    pairs = examples.select("id", "ground_truth").join(one_per_key(answered, "id", "prediction"), "id", "left")
    # Graded once and written, without the generated texts: those are moved only for the samples.
    graded = materialize(grade(pairs))
    missing = F.col(_ANSWERED).isNull()
    kept = graded.filter(~missing & gradable())
    reason = F.when(missing, "no_prediction").otherwise("no_ground_truth")
    return Evaluation(
        model=model,
        report=report_rows(eval_report(kept), model),
        samples=kept.join(answers.select("id", "prediction"), "id").select(*EVAL_ROW.names, *GRADE_FLAGS),
        rejects=graded.filter(missing | ~gradable()).select("id", reason.alias("reason")),
    )


@dataclass(frozen=True)
class RunEvaluations:
    """Of many runs: a summary per run, the graded samples with their flags, and what could not be graded."""

    report: DataFrame
    samples: DataFrame
    rejects: DataFrame

    def write(self, folder: str) -> str:
        """Write the samples of all runs at once, a folder ``run_name=..`` for each, and return the folder above them."""
        path = f"{folder.rstrip('/')}/samples"
        self.samples.withColumnRenamed("run", "run_name").write.mode("overwrite").partitionBy("run_name").parquet(path)
        return path


def evaluate_by_run(dataset: DataFrame, predictions: DataFrame) -> RunEvaluations:
    """Grade the predictions of all runs in one pass: ``predictions`` has ``run, id, prompt_text, generated``.

    A run has one prediction per example at most; two are an error. An example's runs are many rows under one key and are split
    where they are a large share of all. Predictions without an example and answers without a ground truth are rejects.
    """
    named = predictions.withColumn("id", F.struct("run", "id"))
    answers = predicted_answers(named)
    unique = one_per_key(answers.select("id", "predicted_answer"), "id", "prediction").select("id.*", "predicted_answer")
    numbered = unique.withColumn("gen", F.col("run"))
    matched, unmatched = match_truth(numbered, dataset.select("id", "ground_truth"))
    # Graded once and written, without the generated texts: those are moved only for the samples.
    graded = materialize(grade(matched.drop("gen")))
    kept = graded.filter(gradable())
    texts = answers.select("id.*", "prediction")
    lost = unmatched.select("run", "id", F.lit("no_example").alias("reason"))
    return RunEvaluations(
        report=eval_report(kept, "run"),
        samples=kept.join(texts, ["run", "id"]).select("run", *EVAL_ROW.names, *GRADE_FLAGS),
        rejects=lost.unionByName(graded.filter(~gradable()).select("run", "id", F.lit("no_ground_truth").alias("reason"))),
    )
