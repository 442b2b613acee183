"""Tables written by the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import report_name
from tallymark.operators.metrics import GRADE_FLAGS
from tallymark.operators.samples import first_image
from tallymark.schemas import EVAL_ROW


def write_jsonl(df: DataFrame, path: str, order: Column | str | None = None) -> None:
    """One JSON object per line in UTF-8, with nulls and in column order.

    ``order`` sorts by ranges, so that part files follow each other.
    """
    ordered = df if order is None else df.orderBy(order)
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def report_rows(report: DataFrame, model: str) -> DataFrame:
    """The summary under the name of its model."""
    return report.select(F.lit(model).alias("model_name_or_path"), "*")


def write_report(report: DataFrame, folder: str, model: str) -> str:
    """Write the one-row summary as ``<folder>/eval_<run>.json`` and return that path."""
    named = report.sparkSession.range(1).select(report_name(F.lit(model)).alias("name"))
    path = f"{folder.rstrip('/')}/{named.first()['name']}"
    report_rows(report, model).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_eval_samples(graded: DataFrame, path: str, run: str) -> str:
    """Keep every graded sample and its flags in a table with one folder per run; returns that folder."""
    folder = f"{path.rstrip('/')}/run_name={run}"
    graded.select(*EVAL_ROW.names, *GRADE_FLAGS).write.mode("overwrite").parquet(folder)
    return folder


def rejects(classified: DataFrame) -> DataFrame:
    """Problems that gave no sample, and why: ``split, idx, reason``."""
    return classified.filter(F.col("reason").isNotNull()).select("split", "idx", "reason")


def write_rejects(classified: DataFrame, path: str) -> None:
    rejects(classified).write.mode("overwrite").parquet(path)


def image_manifest(accepted: DataFrame) -> DataFrame:
    """Which picture belongs to which sample, under which name; bytes pass through."""
    return accepted.select("id", "image", first_image(F.col("images"))["bytes"].alias("bytes"))


def write_image_manifest(accepted: DataFrame, path: str) -> None:
    image_manifest(accepted).write.mode("overwrite").parquet(path)
