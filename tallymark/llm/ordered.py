"""Running sums within groups of any size, without a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.operators.skew import shuffle_partitions

_RANGE, _BEFORE, _WITHIN = "__range", "__range_before", "__range_within"


def running_sums(rows: DataFrame, group: str, order: Sequence[str], amount: str, name: str, groups: DataFrame) -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` over the rows of their ``group`` that come earlier in ``order``.

    ``order`` must be unique within the group; no group may be null. ``groups`` has one row per group, whose other columns
    are added too. The rows are sorted into ranges of group and order and written, which fixes who is in which range even if
    executors are lost; a large group fills many ranges, and a range may hold many groups. One sum for each pair of a range
    and a group is added up over the ranges of the group; these pairs are as many as there are ranges and groups together.
    No window, join or sort has more rows of one key than a range has.
    """
    ranged = rows.repartitionByRange(shuffle_partitions(rows), group, *order).withColumn(_RANGE, F.spark_partition_id())
    ranged = materialize(ranged)
    sums = ranged.groupBy(_RANGE, group).agg(F.sum(amount).alias(_BEFORE))
    earlier = Window.partitionBy(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(_BEFORE).over(earlier), F.lit(0))
    offsets = materialize(sums.withColumn(_BEFORE, before).join(groups, group))
    within = Window.partitionBy(_RANGE, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn(_WITHIN, F.coalesce(F.sum(amount).over(within), F.lit(0)))
    joined = summed.join(offsets, [_RANGE, group])
    return joined.withColumn(name, (F.col(_BEFORE) + F.col(_WITHIN)).cast("long")).drop(_RANGE, _BEFORE, _WITHIN)
