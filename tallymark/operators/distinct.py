"""Grading each distinct pair of texts once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.equivalence import math_equal
from tallymark.operators.skew import dealt, join_unique
from tallymark.storage import materialize

_PAIR = "__pair"


def math_equal_distinct(df: DataFrame, left: str, right: str, name: str = "equal", spread: Sequence[str] | None = None) -> DataFrame:
    """Add :func:`~tallymark.functions.math_equal` of two text columns, computed once for every distinct pair of texts.

    Pairs are told apart by a digest and combined before the shuffle; what is graded are the distinct ones, dealt out evenly.
    The results are joined back, where a pair with a large share of all rows is split by the ``spread`` columns (by default
    all others). Pays off where answers repeat: many completions have few different answers. ``df`` is read twice, so pass a
    written table. A pair with a null has no result.
    """
    text = F.concat(F.octet_length(left).cast("string"), F.lit(":"), F.col(left), F.col(right))
    keyed = df.withColumn(_PAIR, F.sha2(text.cast("binary"), 256))
    others = list(spread or [c for c in df.columns if c not in (left, right)] or [left])
    texts = keyed.filter(F.col(_PAIR).isNotNull())
    # Texts that repeat take little room in a file, which one task then reads: rows are dealt out before they are combined. As
    # keys they are combined in hash tables; as first values all rows of a task would be sorted.
    found = dealt(texts, *others).groupBy(_PAIR, left, right).agg(F.count(F.lit(1)).alias("n"))
    graded = materialize(dealt(found, _PAIR).select(_PAIR, math_equal(F.col(left), F.col(right)).alias(name)))
    joined = join_unique(keyed, graded, _PAIR, spread=others, how="left", known_unique=True)
    return joined.select(*df.columns, name)
