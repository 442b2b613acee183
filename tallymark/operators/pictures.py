"""Whether pictures are whole, from their bytes alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymark.functions.grammar import applied, case, let_sql

# Bytes of a chunk without data: length, type and checksum.
_LEAST_CHUNK = 12


def _number(at: str, size: int) -> str:
    """A number of ``size`` bytes, the highest first, from the 1-based place ``at`` of the bytes ``b``."""
    return f"CAST(conv(hex(substring(b, {at}, {size})), 16, 10) AS BIGINT)"


def _png() -> str:
    """Chunk after chunk, each with its checksum, from the header to the end chunk."""
    whole = f"z.at + n + {_LEAST_CHUNK} - 1 <= length(b)"
    checked = f"crc32(substring(b, z.at + 4, n + 4)) = {_number('CAST(z.at + 8 + n AS INT)', 4)}"
    kind = "hex(substring(b, z.at + 4, 4))"
    next_ = f"named_struct('at', CAST(z.at + n + {_LEAST_CHUNK} AS INT), 'state', CASE WHEN {kind} = '49454E44' THEN 'whole' ELSE 'open' END)"
    first = f"(z.at > 9 OR ({kind} = '49484452' AND n = 13))"
    sound = f"n < 2147483000 AND {first} AND {whole}"
    step = let_sql("n", _number("z.at", 4), case((sound, case((checked, next_), otherwise="named_struct('at', z.at, 'state', 'broken')")), otherwise="named_struct('at', z.at, 'state', 'broken')"))
    walk = f"(z, i) -> CASE WHEN z.state = 'open' THEN {step} ELSE z END"
    return f"aggregate(sequence(0, length(b) div {_LEAST_CHUNK}), named_struct('at', 9, 'state', 'open'), {walk}, z -> z.state = 'whole')"


def _jpeg() -> str:
    """Segment after segment up to the start of the scan, and an end marker (zeros may follow) as the last."""
    marker = "hex(substring(b, z.at, 2))"
    alone = f"({marker} = 'FF01' OR {marker} BETWEEN 'FFD0' AND 'FFD7')"
    after = f"CAST(CASE WHEN {alone} THEN z.at + 2 ELSE z.at + 2 + n END AS INT)"
    state = f"CASE WHEN NOT startswith({marker}, 'FF') OR n < 2 OR {after} > length(b) THEN 'broken' WHEN {marker} = 'FFDA' THEN 'whole' ELSE 'open' END"
    step = let_sql("n", f"coalesce({_number('z.at + 2', 2)}, 0L)", f"named_struct('at', {after}, 'state', {state})")
    walk = f"(z, i) -> CASE WHEN z.state = 'open' AND z.at + 3 <= length(b) THEN {step} ELSE z END"
    segments = f"aggregate(sequence(0, length(b) div 2), named_struct('at', 3, 'state', 'open'), {walk}, z -> z.state = 'whole')"
    ends = r"regexp_replace(hex(substring(b, -64, 64)), '(?:00)+$', '') LIKE '%FFD9'"
    return f"({segments} AND {ends})"


def _webp() -> str:
    """The length in its head, lowest byte first, says how many bytes follow."""
    length = " + ".join(f"{256**k}L * {_number(str(5 + k), 1)}" for k in range(4))
    return f"(length(b) >= 20 AND {length} + 8 <= length(b))"


def image_intact(data: Column) -> Column:
    """Whether the bytes are a picture that is not cut off or damaged as far as its format tells; NULL for no bytes.

    PNG: all chunks are there up to the end chunk and have the right checksums. JPEG: all segments before the scan are there
    and an end marker is the last. GIF: the trailer is the last byte. WebP: all bytes are there that the head announces.
    Other bytes are no picture. Nothing is decoded.
    """
    head = "hex(substring(b, 1, 12))"
    intact = case(
        ("b IS NULL", "CAST(NULL AS BOOLEAN)"),
        (f"startswith({head}, '89504E470D0A1A0A')", _png()),
        (f"startswith({head}, 'FFD8FF')", _jpeg()),
        (f"{head} RLIKE '^47494638(37|39)61'", "(length(b) > 13 AND hex(substring(b, -1, 1)) = '3B')"),
        (f"{head} RLIKE '^52494646.{{8}}57454250'", _webp()),
        otherwise="false",
    )
    return applied("b", intact, data)
