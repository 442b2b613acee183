"""From a table of illustrated problems to the two training tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import SFT_SAMPLES
from tallymark.operators.joins import join_teacher
from tallymark.operators.metrics import prep_summary
from tallymark.operators.samples import (
    RL,
    SFT,
    image_path,
    reject_reason,
    rl_sample,
    sample_id,
    sample_number,
    sft_sample,
    split_of,
    split_rl,
    split_sft,
)
from tallymark.sources.sinks import image_manifest, rejects, write_jsonl
from tallymark.storage import materialize


def classify(problems: DataFrame, count: int = SFT_SAMPLES, data_dir: str = "data") -> DataFrame:
    """Problems with their split, sample id, picture path and reason for rejection, if any."""
    return (
        problems.withColumn("split", split_of(F.col("idx"), count))
        .withColumn("id", sample_id(F.col("idx"), count))
        .withColumn("image", image_path(data_dir, F.col("split"), F.col("id")))
        .withColumn("reason", reject_reason(F.col("images")))
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reason").isNull())


def _with_teacher(samples: DataFrame, teacher: DataFrame | None) -> DataFrame:
    if teacher is None:
        return samples.withColumn("teacher_completion", F.lit(None).cast("string"))
    return join_teacher(samples, teacher)


_TEXTS = ("idx", "split", "id", "image", "problem", "answer", "reason")


def _sft(classified: DataFrame, teacher: DataFrame | None) -> DataFrame:
    head = accepted(classified).filter(F.col("split") == SFT).select("id", "image", "problem", "answer")
    return sft_sample(_with_teacher(head, teacher))


def _rl(classified: DataFrame) -> DataFrame:
    return rl_sample(accepted(classified).filter(F.col("split") == RL))


def prepare_sft(
    problems: DataFrame, count: int = SFT_SAMPLES, data_dir: str = "data", teacher: DataFrame | None = None
) -> DataFrame:
    """Supervised samples of the first ``count`` problems.

    ``teacher`` has ``id, completion`` of successful calls; other samples get the stand-in.
    """
    return _sft(classify(split_sft(problems, count), count, data_dir), teacher)


def prepare_rl(problems: DataFrame, count: int = SFT_SAMPLES, data_dir: str = "data") -> DataFrame:
    """Reinforcement samples of all problems after the first ``count``."""
    return _rl(classify(split_rl(problems, count), count, data_dir))


@dataclass(frozen=True)
class Prepared:
    """All tables that a preparation gives."""

    sft: DataFrame
    rl: DataFrame
    rejects: DataFrame
    images: DataFrame
    summary: DataFrame

    def write(self, folder: str, ordered: bool = False) -> None:
        """Write each table below ``folder``; with ``ordered`` samples are sorted, which shuffles their texts."""
        base = folder.rstrip("/")
        order = sample_number(F.col("id")) if ordered else None
        write_jsonl(self.sft, f"{base}/{SFT}.jsonl", order=order)
        write_jsonl(self.rl, f"{base}/{RL}.jsonl", order=order)
        self.rejects.write.mode("overwrite").parquet(f"{base}/rejects")
        self.images.write.mode("overwrite").parquet(f"{base}/images")
        self.summary.write.mode("overwrite").json(f"{base}/summary")


def prepare_all(
    problems: DataFrame, count: int = SFT_SAMPLES, data_dir: str = "data", teacher: DataFrame | None = None
) -> Prepared:
    """Both splits, the rejected problems, the picture manifest and the counts.

    The source is read once: the classified rows are written with their first picture, and each
    table reads the columns that it needs of them.
    """
    first = F.slice("images", 1, 1).alias("images")
    classified = materialize(classify(problems, count, data_dir).select(*_TEXTS, first))
    texts = classified.select(*_TEXTS)
    return Prepared(
        sft=_sft(texts, teacher),
        rl=_rl(texts),
        rejects=rejects(texts),
        images=image_manifest(accepted(classified)),
        summary=prep_summary(texts),
    )
