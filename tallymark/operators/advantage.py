"""Rewards relative to the other generations for the same prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.fixed import ADVANTAGE_EPS
from tallymark.operators.skew import join_unique


def group_statistics(scored: DataFrame, group: str = "id", reward: str = "total_reward") -> DataFrame:
    """Mean and spread per group. Groups are combined before the shuffle, so their size does not matter."""
    return scored.groupBy(group).agg(
        F.avg(reward).alias("group_mean"),
        F.when(F.min(reward) < F.max(reward), F.stddev_samp(reward)).alias("group_std"),
    )


def group_advantage(
    scored: DataFrame,
    group: str = "id",
    member: str = "gen",
    reward: str = "total_reward",
    eps: float = ADVANTAGE_EPS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``advantage = (reward - mean) / (std + eps)`` within each group; 0 where all rewards are equal.

    Statistics are aggregated and joined back, rather than computed in a window: a window would
    bring a whole group into one task. ``scored`` is read for both, so pass a written table.
    Rows without a group stay and have no advantage.
    """
    statistics = group_statistics(scored, group, reward)
    joined = join_unique(scored, statistics, group, spread=[member], hot=hot, known_unique=True, how="left")
    centred = F.col(reward) - F.col("group_mean")
    advantage = (
        F.when(F.col(reward).isNull() | F.col(group).isNull(), F.lit(None).cast("double"))
        .when(F.col("group_std").isNull() | (F.col("group_std") == 0), F.lit(0.0))
        .otherwise(centred / (F.col("group_std") + F.lit(float(eps))))
    )
    return joined.withColumn("advantage", advantage).drop("group_mean", "group_std")
