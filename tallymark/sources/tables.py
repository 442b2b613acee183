"""Tables read by the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators.index import running_total
from tallymark.operators.samples import field_defaults
from tallymark.schemas import PROBLEM, TEACHER
from tallymark.storage import materialize

_FILE = "__file"
_BLOCK = "__block"
_FIRST = "__first"
_ROW = "__row"
_ROWS = "__rows"
_BEFORE = "__before"
_CORRUPT = "__corrupt"


def scan_problems(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Problem tables in Parquet, with every column of the problem schema.

    A table without ``idx`` gets the position of each row: its position within its file, which
    the reader knows, plus the rows of all earlier files by name. Rows are neither shuffled nor
    sorted for it.
    """
    paths = [path] if isinstance(path, str) else list(path)
    source = spark.read.parquet(*paths)
    if "idx" not in source.columns:
        source = with_positions(source)
    return field_defaults(source).select(*PROBLEM.names).to(PROBLEM)


def with_positions(source: DataFrame, name: str = "idx") -> DataFrame:
    """Add the position of each row in a Parquet source.

    The files' offsets are written, so that Spark knows their size: it sends a short list to all
    tasks, and splits a file with many rows in the join of a long one.
    """
    located = source.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))
    files = source.groupBy(F.col("_metadata.file_path").alias(_FILE)).agg(F.count(F.lit(1)).alias(_ROWS))
    offsets = materialize(running_total(files, [_FILE], _ROWS, _BEFORE).select(_FILE, _BEFORE))
    placed = located.join(offsets, _FILE)
    return placed.select((F.col(_BEFORE) + F.col(_ROW)).alias(name), *source.columns)


def scan_jsonl(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    bad_lines: str = "fail",
    required: Sequence[str] = (),
) -> DataFrame:
    """Rows of a JSON Lines table with an explicit schema.

    A blank or malformed line, or one without a value for a ``required`` field, is an error, or with ``bad_lines="keep"`` a row without values that
    has the line in ``bad_line`` (see :func:`split_bad_lines`).
    """
    return parse_jsonl(spark.read.text(path), schema, bad_lines, required)


def scan_jsonl_positions(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    count: int | None = None,
    name: str = "position",
    bad_lines: str = "fail",
    required: Sequence[str] = (),
) -> DataFrame:
    """As :func:`scan_jsonl`, with the 0-based position of each line: its place in the file after all files of earlier names.

    ``count`` takes the first lines only. Lines are counted for each block of a file that a task reads, and a block begins
    after the lines of all blocks before it; nothing is sorted or moved but these counts. A block's lines are read by one task
    in order, so that their numbers within the task tell their places within the block; both passes see the same blocks.
    """
    if count is not None and count < 0:
        raise ValueError("the number of rows cannot be negative")
    located = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.monotonically_increasing_id().alias(_ROW),
    )
    blocks = located.groupBy(_FILE, _BLOCK).agg(F.count(F.lit(1)).alias(_ROWS), F.min(_ROW).alias(_FIRST))
    offsets = materialize(running_total(blocks, [_FILE, _BLOCK], _ROWS, _BEFORE).select(_FILE, _BLOCK, _FIRST, _BEFORE))
    if count:
        offsets = offsets.filter(F.col(_BEFORE) < count)
    placed = located.join(offsets, [_FILE, _BLOCK]).withColumn(name, F.col(_BEFORE) + F.col(_ROW) - F.col(_FIRST))
    if count:
        placed = placed.filter(F.col(name) < count)
    return parse_jsonl(placed, schema, bad_lines, required, (name,))


def parse_jsonl(
    lines: DataFrame, schema: T.StructType, bad_lines: str = "fail", required: Sequence[str] = (), kept: Sequence[str] = ()
) -> DataFrame:
    """Rows of JSON lines in the column ``value``, of a table or a stream (see :func:`scan_jsonl`), after ``kept`` columns."""
    if bad_lines not in ("fail", "keep"):
        raise ValueError("bad_lines is fail or keep")
    wider = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.select(*kept, "value", F.from_json("value", wider, options).alias("row"))
    is_bad = F.col("row").isNull() | F.col(f"row.{_CORRUPT}").isNotNull() | (F.trim("value") == "")
    for field in required:
        is_bad = is_bad | F.col(f"row.{field}").isNull()
    if bad_lines == "keep":
        bad_line = F.when(is_bad, F.col("value"))
        values = [F.when(~is_bad, F.col(f"row.{field}")).alias(field) for field in schema.names]
        return parsed.select(*kept, *values, bad_line.alias("bad_line"))
    message = F.concat(F.lit("not a JSON object with all that is required: "), F.col("value"))
    checked = parsed.select(*kept, F.when(is_bad, F.raise_error(message)).otherwise(F.col("row")).alias("row"))
    return checked.select(*kept, *[F.col(f"row.{field}").alias(field) for field in schema.names])


def split_bad_lines(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines of a table read with ``bad_lines="keep"``."""
    good = rows.filter(F.col("bad_line").isNull()).drop("bad_line")
    return good, rows.filter(F.col("bad_line").isNotNull()).select("bad_line")


def scan_teacher(spark: SparkSession, path: str) -> DataFrame:
    """Teacher answers obtained elsewhere, of which only successful calls count."""
    return teacher_successes(spark.read.schema(TEACHER).parquet(path))


def teacher_successes(answers: DataFrame) -> DataFrame:
    return answers.filter(F.col("status_code") == 200).select("id", "completion")


def local_path(uri: Column) -> Column:
    """A file name without the scheme of a local file system."""
    return F.regexp_replace(uri, r"^file:/+", "/")


def scan_images(spark: SparkSession, path: str, pattern: str = "*.png") -> DataFrame:
    """Which pictures exist below a folder, and their sizes; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    )
    return files.select(local_path(F.col("path")).alias("image"), F.col("length"))
