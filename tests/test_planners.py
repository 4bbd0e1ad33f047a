"""Windows, tiles, bands, packs and tables on small cases."""

import pytest
from pyspark.sql import functions as F

from lamina.operators import bands, headings, recognise, spans, tables


def test_windows_own_each_row_once(spark):
    rows = spans.detection_windows(spark.createDataFrame([("p", 5000)], "k string, h int"), "k", "h").orderBy("start_y").collect()
    assert [r.start_y for r in rows] == [0, 1792, 2952] and rows[0].ownership_end_y == 1920
    assert all(a.ownership_end_y == b.ownership_start_y for a, b in zip(rows, rows[1:], strict=False)) and rows[-1].ownership_end_y == 5000


def test_patches_own_each_pixel_once(spark):
    rows = spans.patches(spark.createDataFrame([(1, 3900, 1000)], "k int, w int, h int"), "k", "w", "h").orderBy("x_index").collect()
    assert len(rows) == 3
    owned = [x for r in rows for x in range(r.x_own_start, r.x_own_end)]
    assert owned == list(range(3900))


@pytest.mark.parametrize("w,h,n", [(4678, 3308, 2), (10000, 8000, 9), (10984, 7744, 6), (3000, 3000, 1)])
def test_pixel_tiles(spark, w, h, n):
    rows = spans.pixel_tiles(spark.createDataFrame([(1, w, h)], "k int, w int, h int"), "k", "w", "h").collect()
    assert len(rows) == n and all(r.x2 - r.x1 <= 3900 and r.y2 - r.y1 <= 3900 for r in rows)
    assert max(r.x2 for r in rows) == w and max(r.y2 for r in rows) == h


@pytest.mark.parametrize("r,c,shape", [(23, 24, {(23, 6)}), (8, 24, {(8, 12)})])
def test_grid_tiles_are_balanced(spark, r, c, shape):
    frame = spark.createDataFrame([(1, [i * 100 for i in range(r + 1)], [i * 100 for i in range(c + 1)])], "k int, rows array<int>, columns array<int>")
    found = spans.grid_tiles(frame, "k", "rows", "columns").collect()
    assert {(x.row_end - x.row_start, x.column_end - x.column_start) for x in found} == shape
    assert sum((x.row_end - x.row_start) * (x.column_end - x.column_start) for x in found) == r * c


def test_cells_too_large_have_no_tiles(spark):
    frame = spark.createDataFrame([(1, [0, 4000], [0, 100])], "k int, rows array<int>, columns array<int>")
    assert spans.grid_tiles(frame, "k", "rows", "columns").count() == 0


def test_seams(spark):
    frame = spark.createDataFrame([(1, 0, 60), (1, 40, 100)], "k int, a int, b int")
    assert [(r.own_start, r.own_end) for r in spans.seams(frame, ["k"], "a", "b").orderBy("a").collect()] == [(0, 50), (50, 100)]


def test_slices_cover_everything(spark):
    rows = spans.fixed_slices(spark.createDataFrame([(1, 2400), (2, 100), (3, 5000)], "k int, h int"), "k", "h").orderBy("k", "index").collect()
    for k, h in ((1, 2400), (2, 100), (3, 5000)):
        mine = [r for r in rows if r.k == k]
        assert mine[0].start_y == 0 and mine[-1].end_y == h and all(b.start_y <= a.end_y for a, b in zip(mine, mine[1:], strict=False))


def test_context_cells_are_rejected(spark):
    cell = spans.centre_cell(F.col("x"), F.col("y"), F.lit(0.5), F.lit(1000), F.lit(0), F.lit(50), F.lit(25))
    rows = spark.createDataFrame([(10.0, 100.0), (175.0, 150.0)], "x double, y double").select(cell.alias("c")).collect()
    assert rows[0].c is None and (rows[1].c.x, rows[1].c.y) == (1250.0, 250.0)


def projection(spark, values):
    return spark.createDataFrame([("p", 0, values)], "k string, body_start int, ratios array<double>")


def test_cuts_in_blank_bands(spark):
    ink = [0.08] * 8000
    for a, b in ((3150, 3190), (5650, 5690)):
        ink[a:b] = [0.0] * (b - a)
    rows = bands.vertical_ranges(projection(spark, ink), "k").orderBy("index").collect()
    assert [r.method for r in rows] == ["blank_band", "blank_band", "document_end"] and not any(r.overlap_top or r.overlap_bottom for r in rows)
    assert rows[0].start == 0 and rows[-1].end == 8000


def test_dense_pages_overlap(spark):
    rows = bands.vertical_ranges(projection(spark, [0.12] * 7000), "k").orderBy("index").collect()
    assert any(r.overlap_top for r in rows) and all(r.end - r.start <= 3900 for r in rows) and rows[0].start == 0 and rows[-1].end == 7000


def test_pieces_stay_within_the_capacity(spark):
    rows = bands.vertical_ranges(projection(spark, [0.12] * 10000), "k", target=3283, most=3283, least=1500).collect()
    assert rows and all(r.end - r.start <= 3283 for r in rows)


def test_suspicious_lines(spark):
    at = [23, 33, 37, 46, 64, 84, 111] + [111 + 27 * i for i in range(1, 40)]
    rows = bands.clean_lines(spark.createDataFrame([(1, p) for p in at], "k int, p int"), ["k"], "p").collect()
    assert {r.p for r in rows if r.rejected} == {33, 37} and rows[0].minimum_gap == 16


def test_contrast_and_bypass(spark):
    rows = spark.createDataFrame([(1, 0.96, 170, 205, 218), (2, 0.96, 180, 205, 218), (3, 0.985, 190, 200, 200)], "x int, coverage double, gray int, left_gray int, right_gray int")
    assert {r.x for r in bands.contrast_lines(rows).collect()} == {1, 3}


def test_dense_rows_only(spark):
    raster = spark.createDataFrame([(1, 5, x, x < 90 or x == 99) for x in range(100)] + [(1, 10, x, x < 88 or x == 99) for x in range(100)], "k int, y int, x int, ink boolean")
    assert [r.y for r in bands.line_segments(raster, "k", "y", "x", 0.90).collect()] == [5]


def test_density_bands(spark):
    rows = [(1, y, 0.0 if y == 55 else 0.001 if y == 125 else 0.5) for y in range(200)]
    found = bands.density_bands(spark.createDataFrame(rows, "k int, y int, density double"), "k", 0.01, 0.002)
    assert sorted(r.centre for r in found.collect()) == [55, 125]


def test_regular_bands_keep_the_smallest_width(spark):
    frame = spark.createDataFrame([(1, 8 * i, 1) for i in range(100)], "k int, p int, w int")
    assert bands.adaptive_bands(frame, ["k"], "p", "w").count() == 100


def test_regions_are_connected(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 5, 5), (1, 2, 0)], "k int, cx int, cy int")
    assert [(r.x1, r.y1, r.x2, r.y2) for r in bands.ink_regions(cells, "k").orderBy("region").collect()] == [(0, 0, 3, 2), (5, 5, 6, 6)]


def test_packing_of_neighbours(spark):
    frame = spark.createDataFrame([("a", 1, 700), ("a", 2, 900), ("a", 3, 1000), ("b", 1, 2500), ("b", 2, 2500)], "k string, o int, s int")
    packs = {(r.k, r.o): r.pack for r in headings.pack_sections(frame, "k", "o", "s", 3900).collect()}
    assert packs == {("a", 1): 1, ("a", 2): 1, ("a", 3): 1, ("b", 1): 1, ("b", 2): 2}


def test_styles(spark):
    rows = [("p", "a", 1.6, 100.0, 1000.0), ("p", "b", 1.58, 105.0, 1000.0), ("p", "c", 1.3, 150.0, 1000.0), ("p", "d", 1.1, 200.0, 1000.0)]
    found = headings.style_levels(spark.createDataFrame(rows, "page string, id string, ratio double, indent double, w double"), "page", "w")
    assert {r.id: r.level for r in found.collect()} == {"a": 2, "b": 2, "c": 3, "d": 4}


def test_run_levels(spark):
    rows = [("p", 1, "Title"), ("p", 2, "Title"), ("p", 3, "Text"), ("p", 4, "Title")]
    found = headings.run_levels(spark.createDataFrame(rows, "page string, y int, label string"), "page", ["y"])
    assert [r.level for r in found.orderBy("y").collect()] == [2, 3, None, 2]


# --- tables ---

T, X = True, False


def test_cells_are_inserted_by_the_mask():
    grid, told = tables.align([["A", "B", "C"]], [[T, X, T, X, T]])
    assert grid == [["A", "", "B", "", "C"]] and told
    assert tables.align([["A"], ["C"]], [[T], [X], [T]])[0] == [["A"], [""], ["C"]]


def test_extra_rows():
    rows = [["h", "i"], ["", ""], ["h", "i"], ["1", "2"]]
    assert tables.align(rows, [[T, T], [T, T]])[0] == [["h", "i"], ["1", "2"]]
    with pytest.raises(ValueError, match="non-empty"):
        tables.align([["a"], ["b"], ["c"]], [[T], [T]])


def test_two_level_header():
    assert tables.align([["保单年度", ""], ["年龄", "金额"], ["1", "2"]], [[T, T], [T, T]])[0][0] == ["保单年度<br>年龄", "金额"]


def test_parsing():
    cells, problem = tables.parse('<table><tr><td colspan="2">a</td></tr><tr><td>b</td><td>c</td></tr>')
    assert problem.startswith("repaired") and tables.matrix(cells) == [["a", ""], ["b", "c"]]
    assert tables.parse("<table><tr><td>a")[1] == "truncated" and tables.parse("<table></table><table></table>")[1] == "several tables"


def test_aligned_column(spark):
    frame = spark.createDataFrame([(1, "<table><tr><td>A</td><td>C</td></tr></table>", [[T, X, T]]), (2, "<table><tr><td>x", [[T]])], "k int, html string, mask array<array<boolean>>")
    rows = {r.k: r for r in tables.aligned(frame, "k", "html", "mask").collect()}
    assert rows[1].html == "<table><tr><td>A</td><td></td><td>C</td></tr></table>" and rows[2].error == "truncated"


def test_empty_table(spark):
    text = spark.range(1).select(tables.empty_table(F.lit(2), F.lit(3)).alias("t")).first().t
    assert text.count("<tr>") == 2 and text.count("<td></td>") == 6


def test_top_band(spark):
    band = spark.range(1).select(tables.top_context(F.lit(0), F.lit(10), F.lit(100), F.lit(30), F.lit(270)).alias("b")).first().b
    assert (band.x1, band.y1, band.x2, band.y2) == (30, 10, 270, 96)


# --- recogniser ---


def test_each_content_runs_once_and_then_never(spark, tmp_path):
    log = str(tmp_path / "calls")

    def factory():
        def model(row):
            with open(log, "a") as file:
                file.write(row["k"] + "\n")
            return row["k"].upper()

        return model

    work = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "k string")
    empty = spark.createDataFrame([], "k string, result string, created_at timestamp")
    done, stored = recognise.recognise(work, empty, ["k"], factory, skip=F.when(F.col("k") != "a", F.col("k") == "c"))  # null for a
    path = str(tmp_path / "cache")
    assert {r.k: r.result for r in done.collect()} == {"a": "A", "b": "B", "c": ""}
    stored.write.parquet(path)
    assert {r.k: r.result for r in spark.read.parquet(path).collect()} == {"a": "A", "b": "B", "c": ""}
    assert sorted(open(log).read().split()) == ["a", "b"]
    again, _ = recognise.recognise(work, spark.read.parquet(path), ["k"], factory)
    assert again.count() == 3 and sorted(open(log).read().split()) == ["a", "b"]


def test_attempts():
    calls = []

    def flaky(kind, times):
        def call():
            calls.append(1)
            if len(calls) <= times:
                raise kind("x")
            return "ok"

        calls.clear()
        return call

    assert recognise.attempt(flaky(recognise.Temporary, 3)) == ("ok", None, 4)
    assert recognise.attempt(flaky(recognise.Temporary, 99))[2] == 16
    assert recognise.attempt(flaky(recognise.Permanent, 99)) == (None, "permanent: x", 1)
    assert recognise.attempt(flaky(recognise.Empty, 99), blank_ok=True) == ("", None, 4)


def test_strict_mode_raises(spark):
    tiles = spark.createDataFrame([(1, None, "boom")], "k int, result string, error string")
    assert recognise.complete(tiles, "result", "error", F.lit(1), F.lit(1)).first().result == "<table><tr><td></td></tr></table>"
    with pytest.raises(Exception, match="boom"):
        recognise.complete(tiles, "result", "error", F.lit(1), F.lit(1), strict=True).collect()


def test_result_gate(spark):
    rows = ["<table><tr><td>1</td></tr></table>", "<table><tr>", "<table></table><table></table>", "x" * 20 + "abc def ghi jkl mno pq " * 30]
    frame = spark.createDataFrame([(r,) for r in rows], "m string")
    assert [r.v for r in frame.select(recognise.is_valid_result(F.col("m")).alias("v")).collect()] == [True, False, False, False]


def test_contents_region(spark):
    rows = [("p", 0, True, True, 1.5)] + [("p", 10 * i, False, False, 1.0) for i in range(1, 11)] + [("p", 200, False, True, 2.2)]
    frame = spark.createDataFrame(rows, "page string, y1 int, is_anchor boolean, centred boolean, ratio double")
    found = headings.contents_region(frame, "page").collect()
    assert [(r.start_y, r.end_y) for r in found] == [(0, 200)]


def test_semantic_packs(spark):
    rows = [("p", 1, "a", 1000, 100), ("p", 2, "a", 2000, 100), ("p", 3, "b", 3000, 100), ("p", 4, "b", 3000, 100), ("p", 5, "c", 5000, 100)]
    found = headings.semantic_packs(spark.createDataFrame(rows, "page string, ord long, h2_id string, height int, context int"), "page")
    got = {r.ord: (r.pack, r.body_scale) for r in found.collect()}
    assert got[1][0] == got[2][0] and len({got[i][0] for i in (2, 3, 4, 5)}) == 4 and got[5][1] < 1


def test_headings_gate(spark):
    rows = [(0.7, True, 1.1, 0.1), (0.5, True, 1.1, 0.1), (None, False, 1.4, 0.7), (0.9, True, 3.0, 0.9)]
    frame = spark.createDataFrame(rows, "confidence double, matched boolean, ratio double, whitespace double")
    assert [r.h for r in frame.select(headings.is_heading(frame).alias("h")).collect()] == [True, False, True, False]


def test_title_rows_merge(spark):
    rows = [("p", "a", 10, 0, 90, 20, True), ("p", "b", 15, 24, 85, 44, True), ("p", "c", 0, 200, 50, 220, True), ("p", "d", 0, 222, 50, 240, False)]
    found = headings.merge_title_rows(spark.createDataFrame(rows, "page string, id string, x1 int, y1 int, x2 int, y2 int, centred boolean"), "page", 10)
    assert sorted(r.member_ids for r in found.collect()) == [["a", "b"], ["c"], ["d"]]


def test_lines_in_a_heading_box_are_one_heading(spark):
    from lamina.operators import merge

    lines = spark.createDataFrame([(1, 0, 10.0, "保险责任"), (1, 1, 30.0, "说明"), (1, 2, 80.0, "正文")], "image int, line int, y double, text string")
    boxes = spark.createDataFrame([(1, 0, 45, 2)], "image int, y1 int, y2 int, level int")
    assert merge.headed_lines(lines, boxes, "image").first().markdown == "## 保险责任说明\n正文"


def test_axis_falls_back_to_white_bands(spark):
    black = spark.createDataFrame([(1, 0), (1, 50), (1, 100), (2, 0), (2, 100)], "k int, p int")
    white = spark.createDataFrame([(1, 0), (1, 100), (2, 0), (2, 30), (2, 100)], "k int, p int")
    got = {(r.k, r.source): 0 for r in bands.grid_axis(black, white, ["k"]).collect()}
    assert set(got) == {(1, "black_line"), (2, "white_band")}


def test_problems_come_of_one_count(spark):
    from lamina.operators import submit

    names = lambda *x: spark.createDataFrame([(i,) for i in x], "file_name string")
    found = submit.problems(names("a", "b", "b", "c", "d", None), [names("a", "c", "c"), names("c", "b", "e", "e", None)])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [("template_duplicate", "b"), ("duplicate", "c"), ("duplicate", "e"), ("missing", "d"), ("missing", None), ("extra", "e"), ("extra", None)], key=repr
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1


def test_suppression_equals_brute_force_across_batches(spark):
    """Groups of any size, null labels among them, that go on over several Arrow batches."""
    import random

    from lamina.operators import dedup

    rng, rows = random.Random(3), []
    for page, label, n in [(1, "a", 150), (1, None, 9), (1, "b", 1), (2, None, 70), (2, "a", 2), (3, "a", 5), (3, "b", 5), (None, "a", 4)]:
        for i in range(n):
            x, y = rng.randrange(60), rng.randrange(60)
            rows.append((page, label, i, x, y, x + rng.randrange(40), y + rng.randrange(40), rng.randrange(5) / 4))

    def iou(a, b):
        common = max(0, min(a[5], b[5]) - max(a[3], b[3])) * max(0, min(a[6], b[6]) - max(a[4], b[4]))
        union = sum((r[5] - r[3]) * (r[6] - r[4]) for r in (a, b)) - common
        return common / union if union else 0.0

    wanted = []
    for r in sorted(rows, key=lambda r: (-r[7], r[2])):
        if not any(k[:2] == r[:2] and iou(k, r) > 0.3 for k in wanted):
            wanted.append(r)
    frame = spark.createDataFrame(rows, "page long, label string, id int, x1 int, y1 int, x2 int, y2 int, confidence double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("4", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found = dedup.suppress(frame, ["page", "label"], 0.3).collect()
            assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
