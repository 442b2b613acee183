"""Repeated grading of completions of the same problems, against truths that are stored once in buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.rewards import DEFAULT_REWARDS, Reward, score_parts
from tallymark.operators.skew import hot_keys, one_per_key, shuffle_partitions
from tallymark.plans.grade import reduced_completions, reduced_truths
from tallymark.storage import materialize


def store_truths(
    problems: DataFrame,
    table: str,
    rewards: Sequence[Reward] = DEFAULT_REWARDS,
    key: str = "id",
    buckets: int | None = None,
    path: str | None = None,
    mode: str = "error",
) -> DataFrame:
    """Write what the rewards need of each ground truth as a table in buckets of the key, sorted within; returns it.

    A doubled truth is an error here, so that rounds need not look for it. Problems without a key are left out: no
    completion can have them. Spark joins along the buckets only if there are at least as many as shuffle partitions,
    which is the default. ``path`` keeps the files outside the warehouse; ``mode`` is that of ``saveAsTable``.
    """
    buckets = buckets or shuffle_partitions(problems)
    # Moved once: the test for doubled keys and the buckets are along the same partitions.
    truths = reduced_truths(problems, rewards, key).filter(F.col(key).isNotNull()).repartition(buckets, key)
    writer = one_per_key(truths, key, "ground truth").write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return problems.sparkSession.table(table)


def score_round(
    completions: DataFrame, stored: DataFrame, rewards: Sequence[Reward] = DEFAULT_REWARDS, key: str = "id"
) -> DataFrame:
    """``key, gen``, rewards and ``total_reward`` of the completions that have a stored truth (see :func:`store_truths`).

    The truths stay in their buckets; only what the rewards need of a completion is shuffled. Keys with more than one
    partition's worth of completions stay out of that shuffle: there are about as many as partitions, so that their
    truths can be broadcast. The rewards must be those that the truths were stored for.
    """
    reduced = materialize(reduced_completions(completions, rewards, key).filter(F.col(key).isNotNull()))
    hot = F.broadcast(materialize(hot_keys(reduced, key)).select(key))
    rest = reduced.join(hot, key, "left_anti").join(stored.hint("merge"), key)
    split = reduced.join(hot, key, "left_semi").join(F.broadcast(stored.join(hot, key, "left_semi")), key)
    return score_parts(rest.unionByName(split), rewards)
