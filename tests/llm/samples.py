"""Small tables with every kind of awkward row, and plain computations to compare with."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = (
    "term", "pos", "start", "end", "length", "score", "spans", "part", "node", "band", "bucket", "block", "share", "target",
    "n", "blob", "secret_spans", "hits", "item", "words", "terms", "counts", "held_out", "class_id", "kept", "doc_key",
    "sequence_id", "ids", "key", "count", "first", "component",
)


def frame(spark, rows, schema=DOCS, clashing=True):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({name: F.lit("x") for name in CLASHES if name not in df.columns}) if clashing else df


def docs(spark, rows, clashing=True):
    """A table of documents of ``(doc_id, text)`` rows."""
    full = [(i, t, "en" if i is None or i % 2 else "fr", None, None if t is None else len(t)) for i, t in rows]
    return frame(spark, full, clashing=clashing)


def prose(seed: int, n: int, syllables: str = "ba ne to ri mu sa lo ke") -> str:
    pick = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randint(1, 4))) for _ in range(n))
