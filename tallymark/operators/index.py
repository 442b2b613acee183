"""Dense row positions without a sort in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.skew import shuffle_partitions
from tallymark.storage import materialize

_RANGE = "__range"
_BEFORE = "__range_before"
_ONE = "__one"


def running_total(
    df: DataFrame, order: Sequence[str], amount: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Add the sum of ``amount`` over all rows that come earlier in ``order``, a unique key.

    The rows are range-partitioned and written, which fixes who is in which range even if
    executors are lost. Each range is summed and numbered by itself. The driver only adds up one
    number per range; how many ranges there are is a setting, not a matter of the data.
    """
    partitions = partitions or shuffle_partitions(df)
    ranged = materialize(df.repartitionByRange(partitions, *order).withColumn(_RANGE, F.spark_partition_id()))
    sums = {row[_RANGE]: row[_BEFORE] for row in ranged.groupBy(_RANGE).agg(F.sum(amount).alias(_BEFORE)).collect()}
    ranges = sorted(sums)
    before = [0, *accumulate(sums[each] for each in ranges)]
    offsets = df.sparkSession.createDataFrame(list(zip(ranges, before)), f"{_RANGE} int, {_BEFORE} long")
    earlier = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col(_BEFORE) + F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    return ranged.join(F.broadcast(offsets), _RANGE).withColumn(name, total).drop(_RANGE, _BEFORE)


def _unique(keys: DataFrame, order: Sequence[str], copies: str) -> Column:
    """A condition that is an error where a key has a null or more than one copy."""
    null = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in order])
    message = F.concat(F.lit("not a unique key without nulls: "), F.to_json(F.struct(*order)))
    return F.when(null | (F.col(copies) > 1), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))


def stable_index(df: DataFrame, order: Sequence[str], name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order``, which must be a unique key without nulls.

    Only the keys are sorted and written; the rows meet their positions in a join. A key that
    occurs twice or has a null is an error: such rows have no position of their own.
    """
    keys = df.select(*order).withColumn(_ONE, F.lit(1).cast("long"))
    placed = running_total(keys, order, _ONE, name, partitions)
    copies = placed.groupBy(*order).agg(F.count(F.lit(1)).alias(_ONE), F.min(name).alias(name))
    positions = copies.filter(_unique(copies, order, _ONE)).drop(_ONE)
    same = reduce(lambda a, b: a & b, [df[key].eqNullSafe(positions[key]) for key in order])
    return df.join(positions, same).select(*[df[column] for column in df.columns], positions[name])


def first_rows(df: DataFrame, count: int | None, order: str) -> DataFrame:
    """The first ``count`` rows in ``order``, a unique key without nulls; all rows for 0 or None.

    Rows are cut at a boundary key. Only keys are dealt into ranges; of these the driver gets a number of rows each, and one
    range is sorted to find the key of the last row. No list of rows meets in one place, and none is joined.
    """
    if count is not None and count < 0:
        raise ValueError("the number of rows cannot be negative")
    if not count:
        return df
    keys = df.select(order).repartitionByRange(shuffle_partitions(df), order).withColumn(_RANGE, F.spark_partition_id())
    keys = materialize(keys)
    copies = keys.groupBy(_RANGE, order).agg(F.count(F.lit(1)).alias(_ONE))
    sizes = copies.filter(_unique(copies, [order], _ONE)).groupBy(_RANGE).agg(F.sum(_ONE).alias(_ONE)).collect()
    before = 0
    for size in sorted(sizes):
        if before + size[_ONE] >= count:
            last = keys.filter(F.col(_RANGE) == size[_RANGE]).orderBy(order).offset(count - before - 1).limit(1).first()[order]
            return df.filter(F.col(order) <= F.lit(last))
        before += size[_ONE]
    return df
