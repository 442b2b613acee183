"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.storage import materialize, shared_folder

__all__ = ["bounded_broadcast", "fold", "materialize", "shared_folder", "table", "words"]

# A table is sent whole to every executor only if its rows, counted beforehand, take less than this.
BROADCAST_BYTES = 32 << 20

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_SPACES = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``. A null key is taken as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, runs of ASCII letters, digits and anything beyond ASCII. Null has none."""
    plain = F.translate(text, _LOWER.upper() + _SPACES, _LOWER + " " * len(_SPACES))
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def bounded_broadcast(df: DataFrame, text: str | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, to be broadcast if its counted size is below ``limit``; else left to an ordinary join."""
    size = F.count(F.lit(1)) * 64
    if text is not None:
        size = size + F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))
    return F.broadcast(df) if df.agg(size).first()[0] < limit else df
