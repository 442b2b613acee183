"""Secrets in texts, found through an incremental ledger of blobs.

A *version* is a row of a table of texts with a path. Its text is a blob, named by the SHA-256 of its UTF-8 bytes, so a
text that occurs a thousand times is one blob. The ledger is a written table of the (blob, rule, rule version) triples
that have been scanned, with their findings; a run scans only the triples that the ledger doesn't have, appends them, and
joins the findings back to all paths. Everything is DataFrame expressions.

Spans are in code points, the end exclusive. A null text counts as empty; empty texts are blobs without findings. Paths
may be null or repeated: every row gets the findings of its text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import materialize, shared_folder

_LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern; ``group`` of a match must have ``least`` characters. A change of either needs a new version."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs are taken whole, so asking for the least length in the pattern finds the same ones.
RULES = (
    Rule("assign", _ASSIGN, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)


def _spans(text: Column, rule: Rule) -> Column:
    """Places of the leftmost matches that don't overlap; those whose group is too short are dropped afterwards.

    The texts between matches come from a split by the same pattern, so a match's place is the sum of what lies before.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    pieces = F.split(text, rule.pattern, -1)
    parts = F.zip_with(
        F.arrays_zip(matches.alias("m"), groups.alias("g")),
        F.slice(pieces, 1, F.size(matches)),
        lambda m, before: F.struct(
            F.length(before).alias("before"), F.length(m["m"]).alias("long"), F.length(m["g"]).alias("held")
        ),
    )
    empty = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + p["before"] + p["long"]).alias("at"),
            F.when(
                p["held"] >= rule.least,
                F.array_append(
                    a["spans"],
                    F.struct(
                        (a["at"] + p["before"]).alias("start"), (a["at"] + p["before"] + p["long"]).alias("end")
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
    )["spans"]
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), walked).otherwise(empty)


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _blob() -> Column:
    return F.sha2(_text().cast("binary"), 256)


def read_ledger(spark, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was written there yet."""
    try:
        return spark.read.schema(_LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LEDGER)


def _wanted(versions: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    return versions.sparkSession.createDataFrame([(r.kind, r.version) for r in rules], "rule string, version int")


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> None:
    """Scan the (blob, rule, version) triples of ``versions`` that the ledger lacks, and append them.

    The row with the smallest key stands for its blob, so that equal texts are scanned once and a text that was scanned
    in an earlier run is not moved at all. Should two rows be equal in key and text, both are scanned and one is kept.
    """
    seen = read_ledger(versions.sparkSession, path).join(F.broadcast(_wanted(versions, rules)), ["rule", "version"], "left_semi")
    done = seen.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("done"))
    blobs = versions.select(F.col(key).alias("key"), _blob().alias("blob")).groupBy("blob").agg(F.min("key").alias("key"))
    names = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
    todo = F.array_except(names, F.coalesce("done", F.array().cast("array<string>")))
    unseen = blobs.join(done, "blob", "left").select("blob", "key", todo.alias("todo")).filter(F.size("todo") > 0)
    texts = versions.select(F.col(key).alias("key"), _text().alias("text"), _blob().alias("blob"))
    fresh = texts.alias("t").join(
        unseen.alias("u"), (F.col("t.blob") == F.col("u.blob")) & F.col("t.key").eqNullSafe(F.col("u.key"))
    )
    scans = [
        F.when(
            F.array_contains("u.todo", f"{r.kind}:{r.version}"),
            F.struct(F.lit(r.kind).alias("rule"), F.lit(r.version).alias("version"), _spans(F.col("t.text"), r).alias("spans")),
        )
        for r in rules
    ]
    found = fresh.select(F.col("t.blob").alias("blob"), F.explode(F.array_compact(F.array(*scans))).alias("s"))
    found.select("blob", "s.*").dropDuplicates(["blob", "rule", "version"]).write.mode("append").parquet(path)


def findings(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, spans: all spans of the blobs that have any, as ``kind, start, end`` by start and then by order of rules."""
    order = versions.sparkSession.createDataFrame(
        [(r.kind, r.version, i) for i, r in enumerate(rules)], "rule string, version int, nth int"
    )
    ledger = read_ledger(versions.sparkSession, path).join(F.broadcast(order), ["rule", "version"]).filter(F.size("spans") > 0)
    each = ledger.select("blob", "rule", "nth", F.explode("spans").alias("s"))
    spans = F.sort_array(F.collect_set(F.struct("s.start", "nth", F.col("rule").alias("kind"), "s.end")))
    return materialize(each.groupBy("blob").agg(spans.alias("spans")))


def _scanned(versions: DataFrame, path: str | None, rules: tuple[Rule, ...], key: str, name: str) -> DataFrame:
    path = path or shared_folder(versions.sparkSession)
    update_ledger(versions, path, rules, key)
    spans = findings(versions, path, rules).select(F.col("blob").alias("__blob"), F.col("spans").alias("__found"))
    none = F.array().cast("array<struct<start:int,nth:int,kind:string,end:int>>")
    joined = versions.drop(name).withColumn("__blob", _blob()).join(spans, "__blob", "left").drop("__blob")
    return joined.withColumn(name, F.coalesce("__found", none)).drop("__found")


def scan(versions: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES, key: str = "doc_id") -> DataFrame:
    """``versions`` with the column ``secret_spans``, an array of ``start, nth, kind, end``; empty where nothing is found.

    ``path`` is a ledger of earlier runs, to be continued; by default one is begun. A column of that name is replaced.
    """
    return _scanned(versions, path, rules, key, "secret_spans")


def redact(
    versions: DataFrame, path: str | None = None, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", mark: str = "[SECRET]"
) -> DataFrame:
    """``versions`` with each run of overlapping spans replaced by ``mark``; texts without any stay as they are, null too."""
    found = _scanned(versions, path, rules, key, "__spans")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        "__spans",
        zero,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= a["at"],
                F.concat(a["out"], F.substr("text", a["at"] + 1, s["start"] - a["at"]), F.lit(mark)),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
    )
    rest = F.concat(walked["out"], F.substr("text", walked["at"] + 1))
    text = F.when(F.size("__spans") > 0, rest).otherwise(F.col("text"))
    return found.withColumn("text", text).drop("__spans")
