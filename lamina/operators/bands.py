"""Projections and what is read off them: blank bands, cuts, gutters, lines and grids.

A raster is a relation (image, y, x, ink).  Projections are aggregates; bands are islands of a running count.  Windows
are always partitioned by image: one page is one small group.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def text_raster(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, y, x, ink): a text's lines as rows, its characters as pixels; all but spaces is ink."""
    rows = docs.select(key, F.posexplode(F.split(text, "\n")).alias("y", "line"))
    chars = rows.select(key, "y", F.posexplode(F.split("line", "")).alias("x", "c"))
    return chars.where(F.col("c") != "").select(key, "y", "x", (~F.col("c").rlike(r"\s")).alias("ink"))


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, y, ink_count, pixels, start, end): what a text's lines hold, from lengths alone; empty lines have no row.

    ``start`` and ``end`` bound the ink and are null where there is none.
    """
    rows = docs.select(key, F.posexplode(F.split(text, "\n")).alias("y", "line")).where("line <> ''")
    ink, size = F.length(F.regexp_replace("line", r"\s", "")).cast("long"), F.length("line")
    start, end = F.length(F.regexp_extract("line", r"^\s*", 0)), size - F.length(F.regexp_extract("line", r"\s*$", 0))
    return rows.select(key, "y", ink.alias("ink_count"), size.cast("long").alias("pixels"), F.when(ink > 0, start).alias("start"), F.when(ink > 0, end).alias("end"))


def row_extents(raster: DataFrame, key: str, position: str, along: str) -> DataFrame:
    """(key, position, ink_count, start, end) of the rows with ink of a raster."""
    return raster.where("ink").groupBy(key, position).agg(F.count(F.lit(1)).alias("ink_count"), F.min(along).alias("start"), (F.max(along) + 1).alias("end"))


def median_height(lines: DataFrame, by: str, height: str) -> DataFrame:
    """(by, median_height) of visual lines, the measure of headings."""
    return lines.groupBy(by).agg(F.median(height).alias("median_height"))


def smeared_box(raster: DataFrame, key: str, reach_x: int, reach_y: int, width: Column, height: Column) -> DataFrame:
    """(key, x1, y1, x2, y2) of the ink spread by so many pixels, within the page; sparse marks at the edges count."""
    ink = raster.where("ink").groupBy(key).agg(F.min("x").alias("a"), F.min("y").alias("b"), F.max("x").alias("c"), F.max("y").alias("d"), F.first(width).alias("w"), F.first(height).alias("h"))
    low, high = lambda c, r: F.greatest(F.lit(0), F.col(c) - r), lambda c, r, m: F.least(F.col(m), F.col(c) + 1 + r)
    return ink.select(key, low("a", reach_x).alias("x1"), low("b", reach_y).alias("y1"), high("c", reach_x, "w").alias("x2"), high("d", reach_y, "h").alias("y2"))


def projected_tables(lines: DataFrame, key: str, page: str, gap: float = 0.10) -> DataFrame:
    """(key, y1, y2, lines): tables told by their horizontal lines; a gap of more than ``gap`` of the page parts them."""
    w = Window.partitionBy(key).orderBy("y")
    apart = F.coalesce(F.col("y") - F.lag("y").over(w) > gap * F.col(page), F.lit(True))
    numbered = lines.withColumn("_table", F.sum(apart.cast("int")).over(w))
    return numbered.groupBy(key, "_table").agg(F.min("y").alias("y1"), (F.max("y") + 1).alias("y2"), F.count(F.lit(1)).alias("lines")).drop("_table")


def row_projection(raster: DataFrame, key: str) -> DataFrame:
    """(key, y, ink_count, pixels, ratio)."""
    return raster.groupBy(key, "y").agg(F.count_if("ink").alias("ink_count"), F.count(F.lit(1)).alias("pixels")).withColumn("ratio", F.col("ink_count") / F.col("pixels"))


def column_projection(raster: DataFrame, key: str, below: int = 0) -> DataFrame:
    """(key, x, ink_count, pixels, ratio) of the rows from ``below`` on."""
    return raster.where(F.col("y") >= below).groupBy(key, "x").agg(F.count_if("ink").alias("ink_count"), F.count(F.lit(1)).alias("pixels")).withColumn("ratio", F.col("ink_count") / F.col("pixels"))


def islands(values: DataFrame, by: list[str], position: str, flag: Column, least: int = 1, mean: str | None = None) -> DataFrame:
    """(by, start, end, length): maximal runs of consecutive positions where ``flag`` holds.

    ``mean`` names a column whose average over each run is wanted as well, as ``mean``.
    """
    w = Window.partitionBy(*by).orderBy(position)
    marked = values.where(flag).withColumn("_run", F.col(position) - F.row_number().over(w))
    more = [F.avg(mean).alias("mean")] if mean else []
    runs = marked.groupBy(*by, "_run").agg(F.min(position).alias("start"), (F.max(position) + 1).alias("end"), *more)
    return runs.withColumn("length", F.col("end") - F.col("start")).where(F.col("length") >= least).drop("_run")


def choose_boundary(projection: DataFrame, by: list[str], position: str, value: str, target: str, lower: str, upper: str, blank: float, least: int) -> DataFrame:
    """(by, boundary, method) for each group: a cut near ``target`` within [lower, upper].

    The blank band whose middle is nearest wins, then the one with less ink, then the upper one; without a band the row
    of least ink nearest the target.
    """
    inside = projection.where((F.col(position) >= F.col(lower)) & (F.col(position) <= F.col(upper)))
    bands = islands(inside, [*by, target], position, F.col(value) <= blank, least, value)
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    best = bands.groupBy(*by).agg(F.min(F.struct(F.abs(middle - F.col(target)).alias("d"), F.col("mean").alias("m"), middle.alias("at"))).alias("_band"))
    row = inside.groupBy(*by).agg(F.min(F.struct(F.col(value).alias("v"), F.abs(F.col(position) - F.col(target)).alias("d"), F.col(position).alias("at"))).alias("_row"))
    joined = row.join(best, by, "left")
    method = F.when(F.col("_band").isNotNull(), "blank_band").when(F.col("_row.v") <= blank * 5, "minimum_ink").otherwise("fallback_overlap")
    return joined.select(*by, F.coalesce("_band.at", "_row.at").alias("boundary"), method.alias("method"))


def column_gutter(projection: DataFrame, key: str, width: DataFrame, blank: float = 0.002) -> DataFrame:
    """(key, boundary): the middle of the blank band nearest the centre of a page, between 28 % and 72 % of its width.

    Of bands equally near the one with less ink wins, then the left one.  ``width`` is (key, w).  Pages without one have
    no row: they are a single column.
    """
    sized = projection.join(width, key).where((F.col("x") >= F.bround(F.col("w") * 0.28)) & (F.col("x") < F.bround(F.col("w") * 0.72)))
    bands = islands(sized, [key, "w"], "x", F.col("ratio") <= blank, mean="ratio").where(F.col("length") >= F.greatest(F.lit(12), F.bround(F.col("w") * 0.02)))
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    return bands.groupBy(key).agg(F.min(F.struct(F.abs(middle - F.floor(F.col("w") / 2)).alias("d"), F.col("mean").alias("m"), F.col("start").alias("s"), middle.alias("at"))).alias("b")).select(key, F.col("b.at").alias("boundary"))


def content_box(raster: DataFrame, key: str, least: int = 1) -> DataFrame:
    """(key, x1, y1, x2, y2) of the ink; rows with fewer than ``least`` inked pixels count as noise."""
    return box_of_rows(row_extents(raster, key, "y", "x"), key, least)


def box_of_rows(rows: DataFrame, key: str, least: int = 1) -> DataFrame:
    """``content_box`` of rows' extents."""
    rows = rows.where(F.col("ink_count") >= max(1, least))
    return rows.groupBy(key).agg(F.min("start").alias("x1"), F.min("y").alias("y1"), F.max("end").alias("x2"), (F.max("y") + 1).alias("y2"))


def histogram(raster: DataFrame, key: str, gray: str = "gray") -> DataFrame:
    """(key, pixels, ink, dark, least, most) of gray values: below 245 and below 225."""
    v = F.col(gray)
    return raster.groupBy(key).agg(F.count(F.lit(1)).alias("pixels"), F.count_if(v < 245).alias("ink"), F.count_if(v < 225).alias("dark"), F.min(v).alias("least"), F.max(v).alias("most"))


def line_segments(raster: DataFrame, key: str, position: str, along: str, coverage: float = 0.90, least_span: int = 1) -> DataFrame:
    """(key, position, start, end, coverage): rows whose ink fills their own active span."""
    return segments_of_rows(row_extents(raster, key, position, along), key, position, coverage, least_span)


def segments_of_rows(rows: DataFrame, key: str, position: str, coverage: float = 0.90, least_span: int = 1) -> DataFrame:
    """``line_segments`` of rows' extents."""
    lines = rows.where("ink_count > 0").select(key, position, "start", "end", (F.col("ink_count") / (F.col("end") - F.col("start"))).alias("coverage"))
    return lines.where((F.col("end") - F.col("start") >= least_span) & (F.col("coverage") >= coverage))


def contrast_lines(columns: DataFrame, coverage: float = 0.95, contrast: int = 30, bypass: float = 0.98) -> DataFrame:
    """Columns (coverage, gray, left_gray, right_gray) that are lines: filled and darker than both sides, or very full."""
    darker = (F.least("left_gray", "right_gray") - F.col("gray")) >= contrast
    return columns.where((F.col("coverage") >= bypass) | ((F.col("coverage") >= coverage) & darker))


def clean_lines(lines: DataFrame, by: list[str], position: str, least_cell: int = 18, share: float = 0.12, factor: float = 0.60) -> DataFrame:
    """The lines with ``rejected``: those with a narrow gap on both sides.

    A gap is narrow below min(least_cell, factor * median gap); where more than ``share`` of a group's gaps are narrow,
    its columns are dense and nothing is rejected.
    """
    w = Window.partitionBy(*by).orderBy(position)
    gaps = lines.withColumn("_before", F.col(position) - F.lag(position).over(w)).withColumn("_after", F.lead(position).over(w) - F.col(position))
    typical = gaps.groupBy(*by).agg(F.median("_after").alias("_typical")).withColumn("minimum_gap", F.least(F.lit(least_cell), F.floor(F.col("_typical") * factor)))
    told = gaps.join(typical, by)
    narrow = told.groupBy(*by).agg((F.count_if(F.col("_after") < F.col("minimum_gap")) / F.count("_after")).alias("_share"))
    both = F.coalesce((F.col("_before") < F.col("minimum_gap")) & (F.col("_after") < F.col("minimum_gap")), F.lit(False))
    return told.join(narrow, by).withColumn("rejected", both & (F.col("_share") <= share)).drop("_before", "_after", "_typical", "_share")


def regularity(positions: DataFrame, by: list[str], position: str, tolerance: float = 0.25) -> DataFrame:
    """(by, gaps, regularity): the share of gaps within ``tolerance`` of the median gap."""
    w = Window.partitionBy(*by).orderBy(position)
    gaps = positions.withColumn("_gap", F.lead(position).over(w) - F.col(position)).where("_gap IS NOT NULL")
    typical = gaps.groupBy(*by).agg(F.median("_gap").alias("_typical"))
    return gaps.join(typical, by).groupBy(*by).agg(F.count(F.lit(1)).alias("gaps"), F.avg((F.abs(F.col("_gap") - F.col("_typical")) <= tolerance * F.col("_typical")).cast("double")).alias("regularity"))


def adaptive_bands(bands: DataFrame, by: list[str], position: str, width: str, widths: range = range(1, 8), regular: float = 0.90, gain: float = 0.08) -> DataFrame:
    """The bands of the smallest width limit that makes their spacing regular.

    Limit 1 stays if its regularity reaches ``regular``; else the limit of the best regularity, if it gains ``gain``.
    """
    tried = bands.withColumn("_limit", F.explode(F.array(*[F.lit(i) for i in widths]))).where(F.col(width) >= F.col("_limit"))
    score = regularity(tried, [*by, "_limit"], position)
    first = score.where(F.col("_limit") == min(widths)).select(*by, F.col("regularity").alias("_first"))
    best = score.groupBy(*by).agg(F.max_by("_limit", F.struct(F.col("regularity"), -F.col("_limit"))).alias("_best"), F.max("regularity").alias("_score"))
    limit = best.join(first, by, "left").withColumn("minimum", F.when((F.coalesce("_first", F.lit(0.0)) >= regular) | (F.col("_score") < F.coalesce("_first", F.lit(0.0)) + gain), F.lit(min(widths))).otherwise(F.col("_best")))
    return bands.join(limit.select(*by, "minimum"), by).where(F.col(width) >= F.col("minimum"))


def dilate(values: DataFrame, by: list[str], position: str, flag: str, reach: int) -> DataFrame:
    """``flag`` spread to positions up to ``reach`` away."""
    w = Window.partitionBy(*by).orderBy(position).rangeBetween(-reach, reach)
    return values.withColumn("dilated", F.max(F.col(flag).cast("int")).over(w) == 1)


def kernel(side: Column, ratio: float) -> Column:
    """Size of a dilation kernel, at least 1."""
    return F.greatest(F.lit(1), F.bround(side * F.lit(ratio))).cast("int")


def merge_shallow(tables: DataFrame, by: list[str], page: str, title: float = 0.05, below: float = 0.10) -> DataFrame:
    """Regions (y1, y2): one of at most 5 % of the page and 10 % of the next region's height joins that one.

    Empty regions (y1 = y2) come before the one that starts there; equal ones are counted one by one.
    """
    w = Window.partitionBy(*by).orderBy("y1", "y2")
    height, following = F.col("y2") - F.col("y1"), F.lead("y2").over(w) - F.lead("y1").over(w)
    shallow = F.coalesce((height <= title * F.col(page)) & (height <= below * following), F.lit(False))
    marked = tables.withColumn("_down", shallow)
    started = marked.withColumn("_group", F.sum(F.when(F.coalesce(F.lag("_down").over(w), F.lit(False)), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return started.groupBy(*by, page, "_group").agg(F.min("y1").alias("y1"), F.max("y2").alias("y2")).drop("_group")


def density_bands(rows: DataFrame, key: str, blank: float, deep: float, least: int = 1) -> DataFrame:
    """(key, start, end, centre): horizontal bands of low density; a single row counts only if it is very empty."""
    runs = islands(rows, [key], "y", F.col("density") <= blank, least)
    lowest = runs.join(rows.select(key, "y", "density"), key).where((F.col("y") >= F.col("start")) & (F.col("y") < F.col("end"))).groupBy(key, "start", "end").agg(F.min("density").alias("low"))
    return lowest.where((F.col("end") - F.col("start") > 1) | (F.col("low") <= deep)).select(key, "start", "end", F.floor((F.col("start") + F.col("end") - 1) / 2).alias("centre"))


def grid_axis(black: DataFrame, white: DataFrame, by: list[str]) -> DataFrame:
    """Boundaries of an axis: its black lines where there are any between the edges, else its white bands."""
    lined = black.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where("_n > 2").select(*by)
    return black.join(lined, by, "left_semi").withColumn("source", F.lit("black_line")).unionByName(white.join(lined, by, "left_anti").withColumn("source", F.lit("white_band")))


def vertical_ranges(projections: DataFrame, key: str, target: int = 3200, most: int = 3900, header: int = 0, least: int = 2200, radius: int = 600, overlap: int = 160, blank: float = 0.001, band: int = 8) -> DataFrame:
    """(key, index, start, end, overlap_top, overlap_bottom, method): cuts of a tall page.

    ``projections`` is (key, body_start, ratios: array of row ink).  Each cut looks for a blank band within ``radius``
    of its even share, where neither this piece nor those left could become too tall or too short; a cut through ink
    gives both sides some of the other.  A cut depends on the one before, so a page is one fold.  Pages that need no
    cut have no rows.
    """
    import numpy as np

    def cut(ink: np.ndarray, goal: int, low: int, high: int) -> tuple[int, str]:
        low, high = max(1, low), min(len(ink) - 1, high)
        if low >= high:
            return low, "minimum_ink"
        part = ink[low : high + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (part <= blank).astype(int), [0]])))
        found = [(abs((a + b) // 2 - goal), float(ink[a:b].mean()), (a + b) // 2) for a, b in (edge.reshape(-1, 2) + low).tolist() if b - a >= band]
        if found:
            return min(found)[2], "blank_band"
        rows = np.flatnonzero(part == part.min()) + low
        return int(rows[np.abs(rows - goal).argmin()]), "minimum_ink" if part.min() <= 5 * blank else "fallback_overlap"

    def plan(batches):
        for pdf in batches:
            out = []
            for k, body, ratios in zip(pdf[key], pdf["body_start"], pdf["ratios"], strict=True):
                ink, body = np.asarray(ratios, float), int(body)
                gap, height = 10 if header else 0, len(ink)
                room = most - header - gap
                if room <= least:
                    raise ValueError(f"a header of {header} leaves no room")
                safe = max(least, room - overlap)
                n = max(1, -(-(height - body) // min(safe, max(least, target - header - gap))))
                if n == 1:
                    continue
                short = min(least, max(128, int((height - body) / n * 0.45)))
                cuts = [(body, "document_start")]
                for i in range(1, n):
                    goal = body + round((height - body) * i / n)
                    cuts.append(cut(ink, goal, max(cuts[-1][0] + short, goal - radius), min(cuts[-1][0] + safe, height - (n - i) * short, goal + radius)))
                cuts.append((height, "document_end"))
                for i, ((a, before), (b, after)) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    start = max(body, a - overlap // 2 * (before == "fallback_overlap"))
                    end = min(height, b + (overlap - overlap // 2) * (after == "fallback_overlap"))
                    out.append((k, i, start, end, a - start, end - b, after))
            yield pd.DataFrame(out, columns=[key, "index", "start", "end", "overlap_top", "overlap_bottom", "method"])

    kind = projections.schema[key].dataType.simpleString()
    return projections.select(key, "body_start", "ratios").mapInPandas(plan, f"{key} {kind}, index int, start long, end long, overlap_top long, overlap_bottom long, method string")


def ink_regions(cells: DataFrame, key: str) -> DataFrame:
    """(key, region, x1, y1, x2, y2): boxes of connected coarse cells (key, cx, cy), by repeated least labels."""
    import numpy as np

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        at = {(x, y): i for i, (x, y) in enumerate(zip(pdf["cx"], pdf["cy"], strict=True))}
        label = np.arange(len(pdf))
        links = [(i, at[n]) for (x, y), i in at.items() for n in ((x + 1, y), (x, y + 1), (x + 1, y + 1), (x - 1, y + 1)) if n in at]
        a, b = (np.array([link[i] for link in links], int) for i in (0, 1))
        while len(a):
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (before == label).all():
                break
        out = pdf.assign(region=label).groupby("region").agg(x1=("cx", "min"), y1=("cy", "min"), x2=("cx", "max"), y2=("cy", "max")).reset_index(drop=True)
        out = out.sort_values(["y1", "x1"], ignore_index=True)
        return pd.DataFrame({key: pdf[key].iloc[0], "region": out.index, "x1": out.x1, "y1": out.y1, "x2": out.x2 + 1, "y2": out.y2 + 1})

    kind = cells.schema[key].dataType.simpleString()
    return cells.select(key, "cx", "cy").distinct().groupBy(key).applyInPandas(join, f"{key} {kind}, region int, x1 long, y1 long, x2 long, y2 long")
