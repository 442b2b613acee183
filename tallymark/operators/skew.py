"""Joins that survive keys holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sketches are merged in this many tasks, so that not all map tasks report to one.
_SKETCH_TASKS = 64
# Keys that a sketch reports per shuffle partition, and counters it keeps for each of them. A key that fills a
# partition is among as many of the most frequent ones as there are partitions. The last is Spark's own bound.
_SKETCH_KEYS = 2
_SKETCH_ITEMS = 8
_MOST_ITEMS = 1_000_000

# Parts per shuffle partition's worth of rows: small parts spread more evenly over the partitions.
_PARTS = 4

_SALT = "__salt"
_SALTS = "__salts"
_COPIES = "__copies"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out over as many tasks as there are shuffle partitions, by a hash of ``keys``.

    For work that costs far more than its rows' bytes suggest: by their bytes a small file is read in one task, and the
    partitions of a small shuffle are put together. A number that is asked for stays. Deal narrow rows, before texts are made.
    """
    return df.repartition(shuffle_partitions(df), *keys)


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Keys with more than one shuffle partition's worth of rows, and how many parts to split each into.

    One pass over the key column with a bounded sketch per task and no shuffle by key. The result
    has fewer rows than there are shuffle partitions but for counting errors, so it can be
    broadcast. It only routes rows: an approximate count cannot change the result of a join.
    """
    partitions = partitions or shuffle_partitions(df)
    items = min(_MOST_ITEMS, max(1_000, partitions * _SKETCH_KEYS * _SKETCH_ITEMS))
    keys = min(items // _SKETCH_ITEMS, max(100, partitions * _SKETCH_KEYS))
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(_SKETCH_TASKS)).alias("task")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k(`{key}`, {keys}, {items})").alias("top"),
    )
    merged = sketches.agg(F.sum("rows").alias("rows"), F.flatten(F.collect_list("top")).alias("top"))
    counted = (
        merged.select("rows", F.explode("top").alias("found"))
        .groupBy(F.col("found.item").alias(key), "rows")
        .agg(F.sum("found.count").alias("count"))
    )
    fill = F.col("count") * partitions / F.col("rows")
    hot = counted.filter((fill > 1) & F.col(key).isNotNull())
    return hot.select(key, F.ceil(fill * _PARTS).cast("int").alias(_SALTS))


def _salted(df: DataFrame, key: str, hot: DataFrame, spread: Sequence[str], partitions: int) -> DataFrame:
    """Rows of hot keys get one of the key's salts; rows without key get any salt.

    The salt is a hash of ``spread`` and of the number of the task that reads the row, so that
    even equal rows are split. A task that runs again has the same number and sends its rows to
    the same places.
    """
    part = F.xxhash64(*spread, F.spark_partition_id())
    salt = (
        F.when(F.col(key).isNull(), F.pmod(part, F.lit(partitions)))
        .when(F.col(_SALTS).isNotNull(), F.pmod(part, F.col(_SALTS)))
        .otherwise(F.lit(0))
    )
    return df.join(F.broadcast(hot), key, "left").withColumn(_SALT, salt.cast("int")).drop(_SALTS)


def _copied(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """One copy of a row per salt of its key; keys that are not hot have one."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)
    return df.join(F.broadcast(hot), key, "left").withColumn(_SALT, F.explode(salts)).drop(_SALTS)


def _one_per_group(df: DataFrame, key: str, keys: Sequence[str], what: str) -> DataFrame:
    values = [name for name in df.columns if name not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(_COPIES), *[F.first(name).alias(name) for name in values]
    )
    message = F.concat(F.lit(f"more than one {what} row for key "), F.col(key).cast("string"))
    # A filter: unlike a checked column it stays where only some columns, or none, are asked for.
    once = F.when(F.col(_COPIES) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.filter(once).drop(_COPIES)


def one_per_key(df: DataFrame, key: str, what: str = "right-hand") -> DataFrame:
    """The table itself if each key occurs once in it; an error on use if not."""
    return _one_per_group(df, key, [key], what)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    known_unique: bool = False,
    what: str = "right-hand",
) -> DataFrame:
    """Join many rows per key with at most one row per key.

    ``left`` may hold a third of its rows under one key: such keys are split by the ``spread``
    columns, while ``right`` gets a copy of its one row per part. Neither side is broadcast by
    hint; Spark does it where the known size of a side allows.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_unique takes inner or left")
    hot = hot_keys(left, key) if hot is None else hot
    right = _copied(right, key, hot)
    if not known_unique:
        # Grouped by the columns of the join, so that the join needs no second shuffle.
        right = _one_per_group(right, key, [key, _SALT], what)
    left = _salted(left, key, hot, spread, shuffle_partitions(left))
    return left.join(right, [key, _SALT], how).drop(_SALT)


def exists_join(
    left: DataFrame, right: DataFrame, key: str, spread: Sequence[str], missing: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (or, with ``missing``, does not)."""
    hot = hot_keys(left, key) if hot is None else hot
    keys = _copied(right.select(key), key, hot).distinct()
    left = _salted(left, key, hot, spread, shuffle_partitions(left))
    return left.join(keys, [key, _SALT], "left_anti" if missing else "left_semi").drop(_SALT)
