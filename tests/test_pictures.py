"""Pictures made and damaged in Python."""

import random
import struct
import zlib

from pyspark.sql import functions as F

from tallymark.operators import image_intact


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(n, parts=3):
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", n, 1, 8, 2, 0, 0, 0))
    pixels = zlib.compress(random.Random(n).randbytes(3 * n + 1))
    size = len(pixels) // parts + 1
    return b"\x89PNG\r\n\x1a\n" + head + b"".join(chunk(b"IDAT", pixels[i : i + size]) for i in range(0, len(pixels), size)) + chunk(b"IEND", b"")


def jpeg(n):
    def segment(marker, data):
        return bytes([0xFF, marker]) + struct.pack(">H", len(data) + 2) + data

    scan = random.Random(n).randbytes(n).replace(b"\xff", b"\x00")
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0") + segment(0xDB, bytes(65)) + segment(0xDA, bytes(10)) + scan + b"\xff\xd9"


def gif(n):
    return b"GIF89a" + struct.pack("<HHBBB", n, 1, 0, 0, 0) + b"," + bytes(n) + b";"


def webp(n):
    body = b"WEBPVP8 " + struct.pack("<I", n) + bytes(n)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_whole_and_damaged_pictures(spark):
    made = []
    for make in (png, jpeg, gif, webp):
        for n in (8, 300, 5000):
            data = make(n)
            made.append((data, True))
            made += [(data[:k], False) for k in {len(data) - 1, len(data) // 2, 12, 20}]
    data = bytearray(png(300))
    data[60] ^= 1
    made += [(bytes(data), False), (png(40_000, parts=900), True), (jpeg(50) + bytes(7), True)]
    made += [(b"\x89PNG\r\n\x1a\n" + chunk(b"IDAT", b"x") + chunk(b"IEND", b""), False), (b"\x89PNG\r\n\x1a\n\xff\xff\xff\xff" + bytes(40), False)]
    made += [(b"", False), (b"%PDF", False), (b"RIFFxxxxWAVE" + bytes(30), False), (None, None), (b"\xff\xd8\xff", False), (b"\xff\xd8" + b"\xff" * 500, False)]
    df = spark.createDataFrame([(i, None if d is None else bytearray(d)) for i, (d, _) in enumerate(made)], "i int, data binary").repartition(4)
    found = {r.i: r.ok for r in df.select("i", image_intact(F.col("data")).alias("ok")).collect()}
    assert [(i, found[i], made[i][0][:16]) for i in found if found[i] != made[i][1]] == []
