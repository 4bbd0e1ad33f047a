"""Configurations and commands."""

import pytest
from pyspark.sql import functions as F
from test_sources import png

from lamina.__main__ import main
from lamina.config import LongConfig, TableConfig
from lamina.functions.keys import credentials
from lamina.operators import bands, recognise
from lamina.sources import submission


def test_configurations_are_closed_and_digested():
    assert LongConfig.of({}).digest() == LongConfig().digest() != LongConfig(max_height=4000).digest()
    assert TableConfig(single_tile_min_scale=0.5).digest() == TableConfig().digest()
    assert TableConfig.from_json('{"schema_version": 3, "config": {"overlap": 100}}').overlap == 100
    for bad in ({"nope": 1}, {"min_height": 5000}, {"nms_iou": 0}):
        with pytest.raises(ValueError):
            LongConfig.of(bad)


def test_commands(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.png", "b.png"):
        (folder / name).write_bytes(png(100, 5000))
    (folder / "c.jpg").write_bytes(b"\xff\xd8\xff\xd9")  # no frame: a failure, not a stop
    main(["hash-report", str(folder), str(tmp_path / "report")])
    row = spark.read.parquet(str(tmp_path / "report")).first()
    assert (row.image_count, row.unique_image_count, row.reusable_count, row.duplicate_groups) == (3, 2, 1, 1)
    main(["prepare-long", str(folder), str(tmp_path / "windows")])
    assert spark.read.parquet(str(tmp_path / "windows")).count() == 3
    assert [r.file_names for r in spark.read.parquet(str(tmp_path / "windows-failures")).collect()] == [["c.jpg"]]
    main(["prepare-tables", str(folder), str(tmp_path / "tiles"), "--config", '{"max_side": 2000}'])
    assert spark.read.parquet(str(tmp_path / "tiles")).count() == 3


def test_combining(spark, tmp_path):
    write = lambda name, rows: (tmp_path / name).write_text("file_name,ground_truth\n" + "".join(f'{k},"{v}"\n' for k, v in rows))
    write("template.csv", [("b", ""), ("a", "")])
    write("long.csv", [("a", "long\ntext")])
    write("table.csv", [("b", "table")])
    main(["combine-submissions", str(tmp_path / "template.csv"), str(tmp_path / "long.csv"), str(tmp_path / "table.csv"), "--out", str(tmp_path / "out")])
    assert [(r.file_name, r.ground_truth) for r in submission.read(spark, str(tmp_path / "out")).collect()] == [("b", "table"), ("a", "long\ntext")]
    with pytest.raises(ValueError, match="missing"):
        main(["combine-submissions", str(tmp_path / "template.csv"), str(tmp_path / "long.csv"), "--out", str(tmp_path / "bad")])


def sizes():
    """A model that tells which part it read; it fails on the last window."""
    from lamina.operators.recognise import Permanent

    def model(row):
        if row["window_index"] == 2:
            raise Permanent("no")
        return f"part {row['window_index']} of {len(row['content'])}"

    return model


def test_running(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for name in ("a.png", "b.png"):
        (folder / name).write_bytes(png(100, 5000))
    main(["prepare-long", str(folder), str(tmp_path / "plan")])
    for _ in range(2):
        main(["run-long", str(folder), str(tmp_path / "plan"), out, "--model", "test_cli:sizes", "--cache", str(tmp_path / "cache")])
        n = len(png(100, 5000))
        assert [(r.file_name, r.ground_truth) for r in submission.read(spark, out).collect()] == [(f, f"part 0 of {n}\npart 1 of {n}") for f in ("a.png", "b.png")]
        assert spark.read.parquet(f"{out}-failures").select("window_index", "error").collect() == [(2, "permanent: no")]
    assert spark.read.parquet(str(tmp_path / "cache")).count() == 2  # nothing is stored twice


def test_plug_ins(spark):
    assert recognise.loaded("test_cli:sizes") is not None and recognise.detector("projection") is bands.projected_tables
    with pytest.raises(ValueError, match="no table detector"):
        recognise.detector("none")
    with pytest.raises(ValueError, match="module:factory"):
        recognise.loaded("x")
    found = recognise.detect(spark.createDataFrame([(1, 30), (2, 0)], "k int, n int"), ["k"], lambda: lambda row: [("Title", "t", 0.9, 0.0, 0.0, float(i), 1.0) for i in range(row["n"] // 10)])
    assert sorted((r.k, r.x2) for r in found.collect()) == [(1, 0.0), (1, 1.0), (1, 2.0)]


def test_projected_tables_and_smear(spark):
    lines = spark.createDataFrame([("p", y, 1000) for y in (10, 40, 80, 400, 430)], "k string, y int, h int")
    assert [(r.y1, r.y2, r.lines) for r in bands.projected_tables(lines, "k", "h").orderBy("y1").collect()] == [(10, 81, 3), (400, 431, 2)]
    raster = spark.createDataFrame([(1, 2, 1, True, 100, 50), (1, 30, 98, True, 100, 50), (1, 0, 0, False, 100, 50)], "k int, y int, x int, ink boolean, w int, h int")
    box = bands.smeared_box(raster, "k", 3, 4, F.col("w"), F.col("h")).first()
    assert (box.x1, box.y1, box.x2, box.y2) == (0, 0, 100, 35)


def test_credentials(spark):
    text = "url: https://x.example.org/v1\napiKey = 'abc-123'\nuser_id: u1\nuser: u2\nuser_id: u1"
    told = spark.createDataFrame([(text,), ("",)], "t string").select(credentials(F.col("t")).alias("c")).collect()
    assert (told[0].c.url, told[0].c.api_key, told[0].c.users) == ("https://x.example.org/v1", "abc-123", ["u1", "u2"]) and told[1].c.url is None
