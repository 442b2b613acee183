"""Benchmark passages in training texts, found through a positional inverted index.

The index holds postings ``term, document, position`` of the terms that the search can start from. Their frequencies are
counted over the whole corpus first; then each window of a test item takes its two rarest terms as *points*, and only
lists of points are stored. A list shifted by the point's place in the item gives the places where the item could begin;
the lists of a window's two points are intersected on (document, item, beginning), in one grouping without any words, so that
long items cost in proportion to their windows. What remains is compared word by word with the words stored around the posting, so that every match is exact. Everything is DataFrame expressions.

Rows are told apart by id *and* text, so that repeated ids with different texts stay apart and repeated rows get the same
result each. A null or wordless text has no words and no hits; a wordless item has no windows; a null item id is written
as empty text. Other columns of either table are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import BROADCAST_BYTES, bounded_broadcast, materialize, words

WINDOW = 10
_LENGTH = ""  # no word is empty: the posting of this term is a document's length


def _items(benchmark: DataFrame) -> DataFrame:
    """item, item_ids, item_words: one row per distinct word sequence."""
    ids = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    grouped = (
        benchmark.select(ids.alias("id"), words(F.col("text")).alias("item_words"))
        .filter(F.size("item_words") > 0)
        .groupBy("item_words")
        .agg(F.collect_set("id").alias("item_ids"))
    )
    return grouped.select(F.sha2(F.concat_ws(" ", "item_words"), 256).alias("item"), "item_ids", "item_words")


def _windows(items: DataFrame, window: int) -> DataFrame:
    """item, begin, n, needed: the windows of each item, each with its own words only."""
    n = F.least(F.size("item_words"), F.lit(window))
    each = F.transform(
        F.sequence(F.lit(0), F.size("item_words") - n),
        lambda begin: F.struct(begin.alias("begin"), F.slice("item_words", begin + 1, n).alias("needed")),
    )
    return items.select("item", F.explode(each).alias("w")).select("item", "w.begin", F.size("w.needed").alias("n"), "w.needed")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("doc_key"), words(F.col("text")).alias("doc_words")
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, count: how often each of ``terms`` occurs in all texts; terms that don't occur have no row."""
    each = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return each.join(bounded_broadcast(terms, "term"), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def window_points(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """item, begin, n, points: the places in the item of the two rarest terms of each window.

    A window with a term that no text has can't occur and is left out. A window of one word has one point.
    """
    place = windows.select("item", "begin", "n", F.posexplode("needed").alias("at", "term"))
    rated = place.join(counts, "term", "left").groupBy("item", "begin", "n").agg(
        F.sort_array(F.collect_list(F.struct("count", (F.col("begin") + F.col("at")).alias("point"), "term"))).alias("rated"),
        F.count("count").alias("known"),
    )
    return rated.filter(F.col("known") == F.col("n")).select("item", "begin", "n", F.slice("rated", 1, 2).alias("points"))


def postings(docs: DataFrame, terms: DataFrame, radius: int) -> DataFrame:
    """term, doc_id, doc_key, pos, around: every place of ``terms``, and each document's length as the place of "".

    ``around`` holds the ``radius`` words before the place (fewer at the beginning), the word and those after it, for terms
    that ``lead`` a window: those at which its words are compared.
    """
    listed = terms.unionByName(docs.sparkSession.createDataFrame([(_LENGTH, False)], "term string, leads boolean"))
    placed = _keyed(docs).select(
        "doc_id", "doc_key", "doc_words", F.posexplode(F.array_append("doc_words", _LENGTH)).alias("pos", "term")
    )
    first = F.greatest(F.col("pos") - radius, F.lit(0))
    around = F.slice("doc_words", first + 1, F.col("pos") + radius + 1 - first)
    return placed.join(bounded_broadcast(listed, "term"), "term").select(
        "term", "doc_id", "doc_key", "pos", F.when(F.col("leads"), around).alias("around")
    )


@dataclass(frozen=True)
class Index:
    """Written postings, the windows they can answer, the ids of items, and how many words are stored around a posting."""

    postings: DataFrame
    windows: DataFrame
    items: DataFrame
    radius: int


def build_index(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0) -> Index:
    """Count, choose the points of each window and write their postings.

    ``slack`` is how many words more than its own length a window may be spread over in ``near_matches``.
    """
    items = materialize(_items(benchmark))
    terms = materialize(items.select(F.explode("item_words").alias("term")).distinct())
    counts = materialize(term_counts(docs, terms))
    every = materialize(_windows(items, window))
    windows = materialize(window_points(every, counts).join(every.drop("n"), ["item", "begin"]))
    each = windows.select(F.posexplode("points.term").alias("nth", "term"))
    points = materialize(each.groupBy("term").agg((F.min("nth") == 0).alias("leads")))
    radius = window - 1 + slack
    return Index(materialize(postings(docs, points, radius)), windows, items.select("item", "item_ids"), radius)


def _paired(index: Index) -> DataFrame:
    """The windows with ``lead`` and ``other``, their points, and ``pair``, a hash of item and points."""
    points = F.col("points")
    lead, other = points[0], F.get(points, F.lit(1))
    pair = F.xxhash64("item", lead["point"], F.coalesce(other["point"], F.lit(-1)))
    return index.windows.select("item", "begin", "n", "needed", lead.alias("lead"), other.alias("other"), pair.alias("pair"))


def _intersected(index: Index) -> DataFrame:
    """doc_id, doc_key, pair, shift: where a text has both points of a window at one beginning of the item.

    The lists of all points are moved to the item's beginning; the bits of a group say which points of a pair it has.
    """
    first = F.struct(F.col("lead.term").alias("term"), F.col("lead.point").alias("point"), F.when(F.col("other").isNull(), 3).otherwise(1).alias("bit"))
    second = F.struct(F.col("other.term").alias("term"), F.col("other.point").alias("point"), F.lit(2).alias("bit"))
    both = F.when(F.col("other").isNull(), F.array(first)).otherwise(F.array(first, second))
    roles = materialize(_paired(index).select("pair", F.explode(both).alias("r")).select("pair", "r.*").distinct())
    placed = index.postings.filter(F.col("term") != _LENGTH).join(bounded_broadcast(roles, "term"), "term")
    shifted = placed.select("doc_id", "doc_key", "pair", (F.col("pos") - F.col("point")).alias("shift"), "bit")
    return shifted.groupBy("doc_key", "doc_id", "pair", "shift").agg(F.bit_or("bit").alias("bits")).filter("bits = 3").drop("bits")


def phrase_matches(index: Index) -> DataFrame:
    """doc_id, doc_key, item_ids, hits: per document and beginning of an item, the exact windows as words [from, to).

    Only what the intersection leaves meets the words around its posting.
    """
    windows = _paired(index).withColumn("text", F.concat_ws(" ", "needed"))
    met = _intersected(index).join(bounded_broadcast(windows, "text", BROADCAST_BYTES // 4), "pair")
    met = met.filter(F.col("shift") + F.col("begin") >= 0).select(
        "doc_id", "doc_key", "item", "shift", "begin", "n", "needed", F.col("lead.term").alias("term"), (F.col("shift") + F.col("lead.point")).alias("pos")
    )
    met = materialize(met)
    places = materialize(met.select("doc_id", "doc_key", "term", "pos").distinct())

    def same(one: str, two: str) -> Column:
        equal = [F.col(f"{one}.{name}") == F.col(f"{two}.{name}") for name in ("doc_key", "term", "pos")]
        return equal[0] & equal[1] & equal[2] & F.col(f"{one}.doc_id").eqNullSafe(F.col(f"{two}.doc_id"))

    # Rows that repeat have the same words around.
    stored = index.postings.filter(F.col("around").isNotNull()).alias("p").join(bounded_broadcast(places, "term").alias("q"), same("p", "q"), "left_semi")
    stored = stored.groupBy("doc_id", "doc_key", "term", "pos").agg(F.first("around").alias("around"))
    begin = F.col("shift") + F.col("begin")
    # The window's place in the words around its first point, of which there are fewer at the text's beginning.
    place = begin - F.greatest(F.col("m.pos") - index.radius, F.lit(0))
    found = met.alias("m").join(stored.alias("s"), same("m", "s")).filter(F.slice("around", F.greatest(place, F.lit(0)) + 1, F.col("n")) == F.col("needed"))
    hit = F.struct(begin.alias("from"), (begin + F.col("n")).alias("to"))
    found = found.select("m.doc_id", "m.doc_key", "item", "shift", hit.alias("hit"))
    hits = found.groupBy("doc_id", "doc_key", "item", "shift").agg(F.sort_array(F.collect_set("hit")).alias("hits"))
    ids = index.items.withColumn("text", F.concat_ws(" ", "item_ids"))
    return hits.join(bounded_broadcast(ids, "text"), "item").select("doc_id", "doc_key", "item_ids", "hits")


def near_matches(index: Index) -> DataFrame:
    """doc_id, doc_key, item_ids, begin, pos: places of a window's rarest term with all its words, in any order, nearby.

    Nearby is within the stored radius on either side.
    """
    tests = index.windows.join(index.items, "item").select("item_ids", "begin", F.col("points")[0]["term"].alias("term"), "needed")
    met = index.postings.join(bounded_broadcast(tests.withColumn("text", F.concat_ws(" ", "needed")), "text"), "term")
    return met.filter(F.size(F.array_except("needed", "around")) == 0).select("doc_id", "doc_key", "item_ids", "begin", "pos")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, doc_key, n_words, n_hit, n_items, item_ids, contaminated.

    A word is hit if it lies in an occurrence of a window of ``window`` consecutive words of an item; an item with fewer
    words is one window. ``item_ids`` are the items with such windows, sorted as text.
    """
    index = build_index(docs, benchmark, window)
    matches = phrase_matches(index).groupBy("doc_key", "doc_id").agg(
        F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("item_ids"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "hits",
        zero,
        lambda a, h: F.struct(
            F.greatest(a["end"], h["to"]).alias("end"),
            (a["n"] + F.greatest(h["to"] - F.greatest(h["from"], a["end"]), F.lit(0))).alias("n"),
        ),
    )["n"]
    found = matches.select("doc_key", F.col("doc_id").alias("found_id"), covered.alias("hit"), "item_ids")
    lengths = index.postings.filter(F.col("term") == _LENGTH).select("doc_id", "doc_key", F.col("pos").cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("l.doc_key") == F.col("f.doc_key"))
    none = F.array().cast("array<string>")
    return lengths.alias("l").join(found.alias("f"), same, "left").select(
        "doc_id",
        F.col("l.doc_key").alias("doc_key"),
        "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce(F.col("hit") > 0, F.lit(False)).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any occurrence of a window, all columns kept."""
    leaked = contamination(docs, benchmark, window).filter("contaminated").select("doc_key", "doc_id").distinct()
    kept = docs.alias("d").join(
        leaked.alias("x"),
        (F.xxhash64("d.doc_id", "d.text") == F.col("x.doc_key")) & F.col("d.doc_id").eqNullSafe(F.col("x.doc_id")),
        "left_anti",
    )
    return kept
