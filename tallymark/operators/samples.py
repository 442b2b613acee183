"""Projections and filters that turn problems into training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import (
    MOCK_COMPLETION,
    NO_ANSWER,
    RL_ID,
    SFT_ID,
    TEACHER_SYSTEM_PROMPT,
    TEACHER_USER_PROMPT,
)
from tallymark.functions.latex import clean_ground_truth
from tallymark.schemas import CHUNK, PROBLEM, SFT_SAMPLE, RL_SAMPLE

SFT = "sft"
RL = "rl"


def _check_count(count: int) -> int:
    if count < 0:
        raise ValueError("the size of the supervised split cannot be negative")
    return count


def split_sft(problems: DataFrame, count: int) -> DataFrame:
    """The first ``count`` problems by position."""
    return problems.filter(F.col("idx") < _check_count(count))


def split_rl(problems: DataFrame, count: int) -> DataFrame:
    """All problems from position ``count`` on."""
    return problems.filter(F.col("idx") >= _check_count(count))


def split_of(idx: Column, count: int) -> Column:
    """Name of the split of a position."""
    return F.when(idx < _check_count(count), F.lit(SFT)).otherwise(F.lit(RL))


def field_defaults(problems: DataFrame) -> DataFrame:
    """Add missing columns with empty values; null values stay null."""
    empty = {
        "problem": F.lit(""),
        "answer": F.lit(""),
        "images": F.array().cast(PROBLEM["images"].dataType),
    }
    missing = {name: value for name, value in empty.items() if name not in problems.columns}
    return problems.withColumns(missing) if missing else problems


def first_image(images: Column) -> Column:
    """The first picture, NULL without one."""
    return F.get(images, F.lit(0))


def has_image(images: Column) -> Column:
    return F.coalesce(F.size(images) > 0, F.lit(False))


def require_image(problems: DataFrame) -> DataFrame:
    """Drop problems without pictures; positions keep their gaps."""
    return problems.filter(has_image(F.col("images")))


def image_kind(data: Column) -> Column:
    """Format of a picture by the signature in its first bytes; NULL for anything else."""
    head = F.hex(F.substring(data, 1, 12))
    return (
        F.when(head.startswith("89504E470D0A1A0A"), "png")
        .when(head.startswith("FFD8FF"), "jpeg")
        .when(head.rlike("^474946383[79]61"), "gif")
        .when(head.rlike("^52494646.{8}57454250"), "webp")
    )


def reject_reason(images: Column) -> Column:
    """Why a problem gives no sample; NULL where it does."""
    return F.when(~has_image(images), F.lit("no_image")).when(
        image_kind(first_image(images)["bytes"]).isNull(), F.lit("bad_image")
    )


def sample_id(idx: Column, count: int) -> Column:
    """``sft_00007`` or ``rl_00007``; positions in the second split start from 0 again."""
    return F.when(idx < _check_count(count), F.format_string(SFT_ID, idx)).otherwise(
        F.format_string(RL_ID, idx - count)
    )


def sample_number(sample: Column) -> Column:
    """The number in a sample id, by which samples are in order (ids past 99999 are longer)."""
    return F.substring_index(sample, "_", -1).cast("long")


def image_path(data_dir: str, split: Column, sample: Column) -> Column:
    return F.concat_ws("/", F.lit(data_dir.rstrip("/")), F.lit("images"), split, F.concat(sample, F.lit(".png")))


def _fill(template: str, **columns: Column) -> Column:
    """A text template with columns in the places of its names."""
    pieces: list[Column] = []
    rest = template
    while rest:
        text, brace, rest = rest.partition("{")
        if text:
            pieces.append(F.lit(text))
        if brace:
            name, _, rest = rest.partition("}")
            pieces.append(columns[name])
    return F.concat(*pieces)


def _shown(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def mock_completion(question: Column, answer: Column) -> Column:
    """Stand-in completion; an empty answer shows as not available."""
    shown = F.when(F.coalesce(answer, F.lit("")) == "", F.lit(NO_ANSWER)).otherwise(clean_ground_truth(answer))
    return _fill(MOCK_COMPLETION, question=_shown(question), answer=shown)


def completion_fallback(teacher: Column, question: Column, answer: Column) -> Column:
    """Teacher completion, or else the stand-in."""
    return F.coalesce(teacher, mock_completion(question, answer))


def completion_source(teacher: Column) -> Column:
    return F.when(teacher.isNotNull(), F.lit("teacher")).otherwise(F.lit("mock"))


def sft_sample(accepted: DataFrame) -> DataFrame:
    """Project to the supervised sample."""
    return accepted.select(
        "id",
        "image",
        F.col("problem").alias("prompt"),
        completion_fallback(F.col("teacher_completion"), F.col("problem"), F.col("answer")).alias("completion"),
        clean_ground_truth(F.col("answer")).alias("ground_truth"),
        F.col("answer").alias("raw_answer"),
        completion_source(F.col("teacher_completion")).alias("completion_source"),
    ).to(SFT_SAMPLE)


def rl_sample(accepted: DataFrame) -> DataFrame:
    """Project to the reinforcement sample, which has no completion."""
    return accepted.select(
        "id",
        "image",
        F.col("problem").alias("prompt"),
        clean_ground_truth(F.col("answer")).alias("ground_truth"),
        F.col("answer").alias("raw_answer"),
    ).to(RL_SAMPLE)


def teacher_request(
    image: Column,
    question: Column,
    answer: Column,
    system_prompt: str = TEACHER_SYSTEM_PROMPT,
    user_prompt: str = TEACHER_USER_PROMPT,
) -> Column:
    """Messages that ask a teacher for a worked solution, with typed chunks."""

    def chunk(**parts: Column) -> Column:
        return F.struct(*[parts.get(name, F.lit(None)).cast("string").alias(name) for name in CHUNK.names])

    text = F.lit("text")
    user = _fill(user_prompt, question=_shown(question), answer=_shown(answer))
    return F.array(
        F.struct(F.lit("system").alias("role"), F.array(chunk(type=text, text=F.lit(system_prompt))).alias("content")),
        F.struct(
            F.lit("user").alias("role"),
            F.array(
                chunk(type=F.lit("image"), image=F.concat(F.lit("file://"), image)), chunk(type=text, text=user)
            ).alias("content"),
        ),
    )


def teacher_request_json(messages: Column) -> Column:
    """The same messages as JSON, each chunk under the name of its kind only."""
    return F.to_json(
        F.transform(
            messages,
            lambda message: F.struct(
                message["role"].alias("role"),
                F.transform(
                    message["content"],
                    lambda chunk: F.struct(chunk["image"].alias("image"), chunk["text"].alias("text")),
                ).alias("content"),
            ),
        )
    )
