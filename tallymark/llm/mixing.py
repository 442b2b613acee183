r"""Mixing sources to target weights: each source's documents in random order, cut at the source's exact budget.

A document gets a key from a hash of its id and text, so that the order is random but the same in every run. The rows are
range-sorted by source and key, distributed prefix sums tell how many words of its source come before a document, and the
budget cuts there: as many whole epochs as the budget holds, then the documents before the cut once more, and of the one on
the cut the words that are left. DataFrame operations only.

Words are runs of ``[^\x20\x09-\x0D]``; null and empty texts have none and take part with size 0. Sources go by code point,
a null source last, as one source. Null ids are taken as empty; rows that are equal in source, id and text are documents of
their own that can stand for each other. An empty table gives an empty mix. Other columns are ignored by :func:`taken` and
kept by :func:`mixed`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize
from tallymark.llm.ordered import running_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 1
# Copies of one row that a task makes at once.
_COPIES = 1_000

_GAPS = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    ends = F.regexp_replace(F.btrim(text, F.lit(_GAPS)), r"[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.coalesce(F.length(ends), F.lit(0)).cast("long")


def _source() -> Column:
    """The source, never null: bytes in the order of code points, and null after all others."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))


def _content() -> Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))


def _random_key(seed: int, key: Column, content: Column) -> Column:
    """60 random bits, the same for the same seed, id and text."""
    whole = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), content)
    return F.conv(F.substring(F.sha2(whole.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def _ranked(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources`` with ``weight``: the weights in turn, in order of the sources."""
    rows = sources.withColumns({"one": F.lit(1).cast("long"), "all": F.lit(0)})
    everything = sources.sparkSession.createDataFrame([(0,)], "all int")
    ranked = running_sums(rows, "all", ["source"], "one", "rank", everything)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))))
    return ranked.withColumn("weight", weight).drop("one", "all", "rank")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: shares of ``share`` times all sizes by weight.

    No target is above ``most`` times its source's size; what a source can't take is shared among the others by weight. Each
    round is an aggregation of the sources that returns two numbers; capped sources stay capped, so rounds end.
    """
    ranked = materialize(_ranked(sources, weights).withColumn("most", F.col("source_size") * F.lit(float(most))))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > F.col("most")
        left, weight, count = ranked.agg(
            F.lit(float(share) * int(total)) - F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count(F.when(full, 1)),
        ).first()
        if count == capped:
            break
        # Where no source has room left, all get the most they can take.
        level, capped = (left / weight if weight else float("inf")), count
    rate = F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.least(rate, F.col("most"))).drop("weight", "most")


def _plan(
    documents: DataFrame, weights: Sequence[float], share: float, most: float, seed: int, key: str
) -> DataFrame:
    """source (as :func:`_source`), doc_id, content, size, source_size, target and taken, without texts."""
    rows = documents.select(
        _source().alias("source"),
        F.col(key).alias("doc_id"),
        _content().alias("content"),
        n_words(F.col("text")).alias("size"),
    )
    order = _random_key(seed, F.col("doc_id"), F.col("content")).alias("key")
    # Equal rows have equal keys; the row number only keeps them apart, so that they needn't share a range.
    rows = materialize(rows.select("*", order, F.monotonically_increasing_id().alias("row")))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    placed = running_sums(rows, "source", ["key", "content", "row"], "size", "before", materialize(sources))
    budget = F.floor("target").cast("long")
    epochs = F.coalesce(F.call_function("div", budget, F.nullif("source_size", F.lit(0).cast("long"))), F.lit(0).cast("long"))
    placed = placed.withColumns({"budget": budget, "epochs": epochs})
    rest = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")
    part = F.least(F.greatest(rest, F.lit(0).cast("long")), F.col("size"))
    return placed.withColumn("taken", F.col("epochs") * F.col("size") + part).drop("key", "row", "before", "budget", "epochs")


def taken(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, and the number of its words that the mix takes.

    The words taken of a source add up to its target, rounded down.
    """
    return _plan(documents, weights, share, most, seed, key).select("doc_id", "size", "source_size", "target", "taken")


def mixed(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
    key: str = "doc_id",
) -> DataFrame:
    """The mix itself: the rows of ``documents``, each as often as it is taken, without those that aren't.

    A copy that is cut has its first words, joined by single spaces. Of rows that are equal in source, id and text one
    stands for all, with its other columns.
    """
    columns = documents.columns
    same = {"__s": _source(), "__i": F.coalesce(F.col(key).cast("string"), F.lit("")), "__c": _content()}
    plan = _plan(documents, weights, share, most, seed, key).groupBy(
        F.col("source").alias("__s"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__i"), F.col("content").alias("__c")
    ).agg(F.sum("taken").alias("__taken"), F.max("size").alias("__size"))
    plan = plan.filter("__taken > 0").withColumns(
        {"__whole": F.expr("__taken div __size"), "__rest": F.expr("__taken % __size")}
    )
    unique = documents.withColumns(same).dropDuplicates(list(same))
    rows = unique.join(plan, list(same)).withColumn("__n", F.col("__whole") + (F.col("__rest") > 0).cast("long"))
    blocks = rows.withColumn("__block", F.explode(F.expr(f"sequence(0L, (__n - 1) div {_COPIES})")))
    last = F.least(F.col("__n"), (F.col("__block") + 1) * _COPIES) - 1
    spread = blocks.withColumn("__last", last).repartition("__i", "__block")
    copies = spread.withColumn("__copy", F.explode(F.sequence(F.col("__block") * _COPIES, F.col("__last"))))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]++"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("__rest").cast("int")), " ")
    text = F.when(F.col("__copy") < F.col("__whole"), F.col("text")).otherwise(cut)
    return copies.withColumn("text", text).select(*columns)
