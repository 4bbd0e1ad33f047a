"""Files in and out, and incremental ingest."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from lamina.operators import cache
from lamina.sources import images, submission
from lamina.streaming.ingest import ingest


def png(width, height):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)) + chunk(b"IEND", b"")


def test_image_scan(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(png(70, 30))  # a PNG whatever its name says
    (tmp_path / "b.PNG").write_bytes(png(70, 30))
    (tmp_path / "c.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.png").write_bytes(png(1, 1))
    found = images.scan(spark, str(tmp_path)).withColumn("h", images.header(F.col("content"))).orderBy("file_name").collect()
    assert [r.file_name for r in found] == ["a.jpg", "b.PNG"] and found[0].sha256 == found[1].sha256
    assert (found[0].h.format, found[0].h.width, found[0].h.height) == ("PNG", 70, 30)


def test_sizes_of_all_formats(spark):
    jpeg = b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + b"\0" * 9 + b"\xff\xfe" + struct.pack(">H", 300) + b"c" * 298 + b"\xff\xff\xc2" + struct.pack(">HBHHB", 17, 8, 480, 640, 3) + b"\0" * 9
    lossy = b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 640, 480)
    lossless = b"RIFF\0\0\0\0WEBPVP8L\0\0\0\0\x2f" + struct.pack("<I", 639 | 479 << 14)
    extended = b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0\0\0\0\0" + (639).to_bytes(3, "little") + (479).to_bytes(3, "little")
    tiff = lambda o: (b"II*\0" if o == "<" else b"MM\0*") + struct.pack(o + "I", 10) + b"\0\0" + struct.pack(o + "H", 3) + struct.pack(o + "HHIHH", 256, 3, 1, 640, 0) + struct.pack(o + "HHII", 257, 4, 1, 480) + struct.pack(o + "HHII", 258, 4, 1, 8)
    bmp = b"BM" + b"\0" * 16 + struct.pack("<ii", 640, -480)
    files = [("JPEG", jpeg), ("WEBP", lossy), ("WEBP", lossless), ("WEBP", extended), ("TIFF", tiff("<")), ("TIFF", tiff(">")), ("BMP", bmp), ("GIF", b"GIF89a" + struct.pack("<HH", 640, 480)), ("PNG", png(640, 480))]
    found = spark.createDataFrame([(k, bytearray(c)) for k, c in files], "k string, c binary").select("k", images.header(F.col("c")).alias("h")).collect()
    assert [(r.h.format, r.h.width, r.h.height) for r in found] == [(k, 640, 480) for k, _ in files]
    broken = spark.createDataFrame([(bytearray(c),) for c in (b"\xff\xd8\xff", b"\xff\xd8\xff\xd9", b"", b"RIFF\0\0\0\0WEBP", b"II*\0", jpeg[:300], b"text")], "c binary").select(images.header(F.col("c")).alias("h"))
    assert {(r.h.width, r.h.height) for r in broken.collect()} == {(None, None)}


def test_submission_round_trip(spark, tmp_path):
    rows = [("b", "<table>\n\"x\",y</table>"), ("a", ""), ("c", "字" * 200_000)]
    results = spark.createDataFrame(rows, "file_name string, ground_truth string")
    template = spark.createDataFrame([("c", 0), ("b", 1), ("a", 2)], "file_name string, ord int")
    submission.write(results, str(tmp_path / "out"), template)
    back = submission.read(spark, str(tmp_path / "out"))
    assert [(r.file_name, r.ground_truth) for r in back.collect()] == [rows[2], rows[0], rows[1]]
    with pytest.raises(ValueError, match="missing"):
        submission.write(results.where("file_name <> 'a'"), str(tmp_path / "bad"), template)


def test_submission_with_mark_and_bad_names(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿file_name,ground_truth\na,1\na,2\n".encode())
    with pytest.raises(ValueError, match="repeated"):
        submission.read(spark, str(tmp_path / "x.csv"))
    (tmp_path / "y.csv").write_text("name,text\na,1\n")
    with pytest.raises(ValueError, match="header"):
        submission.read(spark, str(tmp_path / "y.csv"))


def test_dataset_order_and_repaired_names(spark):
    official = "长图.png"
    broken = official.encode("utf-8").decode("gb18030")
    template = spark.createDataFrame([("t.png", 0), (official, 1)], "file_name string, ord int")
    found = images.resolve(template, spark.createDataFrame([(broken,)], "file_name string"), spark.createDataFrame([("t.png",)], "file_name string"))
    assert [(r.file_name, r.branch) for r in found.orderBy("ord").collect()] == [("t.png", "table"), (official, "long")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_caches(spark):
    schema = "k string, result string, created_at int"
    first = spark.createDataFrame([("shared", "first", 1), ("blank", "", 1)], schema)
    second = spark.createDataFrame([("shared", "second", 9), ("new", "n", 2)], schema)
    empty = spark.createDataFrame([], schema)
    merged = {r.k: r.result for r in cache.merge(empty, [first, second], ["k"], "created_at").collect()}
    assert merged == {"shared": "first", "blank": "", "new": "n"}
    got = {r.k: r.result for r in cache.lookup(spark.createDataFrame([("blank",), ("none",)], "k string"), first, ["k"]).collect()}
    assert got == {"blank": "", "none": None}
    names = [f"tile_attempt_{i}.md" for i in (1, 9, 10, 2)]
    attempts = spark.createDataFrame([("t", n, "a", "b", "c", None if n.endswith("_10.md") else "m") for n in names], "t string, name string, tile_sha256 string, prompt_sha256 string, cache_key string, model string")
    wanted = spark.createDataFrame([("t", "a", "b", "c", "m")], "t string, tile_sha256 string, prompt_sha256 string, cache_key string, model string")
    assert cache.recover(attempts, wanted, ["t"]).first().name == "tile_attempt_9.md"


def test_ingest_takes_each_file_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    schema = "k string, v int, at int"
    spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], schema).write.parquet(source)
    assert ingest(spark, source, schema, target, check, ["k"], ["at"]).count() == 2
    spark.createDataFrame([("a", 2, 2)], schema).write.mode("append").parquet(source)
    rows = {r.k: r.v for r in ingest(spark, source, schema, target, check, ["k"], ["at"]).collect()}
    assert rows == {"a": 2, "b": 1}
