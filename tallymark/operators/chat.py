"""Samples as chat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.text import strip_image_tag


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_user(prompt: Column) -> Column:
    """One user message with the prompt, without picture placeholders."""
    return F.array(_message("user", strip_image_tag(prompt)))


def chat_sft(samples: DataFrame) -> DataFrame:
    """Question and completion as a conversation."""
    messages = F.array(
        _message("user", strip_image_tag(F.col("prompt"))), _message("assistant", F.col("completion"))
    )
    return samples.select(messages.alias("messages"), "image", "ground_truth", "id")


def chat_rl(samples: DataFrame) -> DataFrame:
    """Question as a conversation to be continued; the truth goes by two names."""
    return samples.select(
        chat_user(F.col("prompt")).alias("prompt"), "image", F.col("ground_truth").alias("answer"), "ground_truth", "id"
    )


def chat_rows(samples: DataFrame, mode: str) -> DataFrame:
    """Chat rows for ``sft`` or ``grpo``."""
    shapes = {"sft": chat_sft, "grpo": chat_rl}
    if mode not in shapes:
        raise ValueError(f"unknown chat mode {mode!r}, known are {sorted(shapes)}")
    return shapes[mode](samples)
