"""Half-open rectangles (x1, y1, x2, y2) as structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1, y1, x2, y2) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def width(b: Column) -> Column:
    return F.greatest(F.lit(0), b["x2"] - b["x1"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0), b["y2"] - b["y1"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def clamp(b: Column, w: Column, h: Column) -> Column:
    """Into the page, left before right and top before bottom."""
    x1, y1 = F.least(F.greatest(b["x1"], F.lit(0)), w), F.least(F.greatest(b["y1"], F.lit(0)), h)
    return box(x1, y1, F.least(F.greatest(b["x2"], x1), w), F.least(F.greatest(b["y2"], y1), h))


def expand(b: Column, px: Column, py: Column, w: Column, h: Column) -> Column:
    return clamp(box(b["x1"] - px, b["y1"] - py, b["x2"] + px, b["y2"] + py), w, h)


def translate(b: Column, dx: Column, dy: Column) -> Column:
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def intersection(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])) * F.greatest(F.lit(0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is empty."""
    common = intersection(a, b)
    return F.coalesce(common / F.nullif(area(a) + area(b) - common, F.lit(0)), F.lit(0.0))


def overlaps_both_ways(a: Column, b: Column, share: float = 0.65) -> Column:
    """Whether two boxes overlap by ``share`` of the smaller one, in width and in height."""
    wide = (F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])) >= F.lit(share) * F.least(width(a), width(b))
    high = (F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])) >= F.lit(share) * F.least(height(a), height(b))
    return wide & high


def center(b: Column) -> tuple[Column, Column]:
    return (b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2


def estimated_width(w: Column, h: Column, max_pixels: Column) -> Column:
    """Width after shrinking to so many pixels."""
    pixels = w.cast("double") * h
    return F.when(pixels <= max_pixels, w.cast("double")).otherwise(w * F.sqrt(max_pixels / pixels))


def needs_split(w: Column, h: Column, max_pixels: Column, trigger: Column, least_width: Column) -> Column:
    return (h > trigger) & (estimated_width(w, h, max_pixels) < least_width)


def is_centered(b: Column, page: Column, max_width: float = 0.60, tolerance: float = 0.08) -> Column:
    """Narrow enough and with its centre near the page's."""
    return (width(b) <= F.lit(max_width) * page) & (F.abs(center(b)[0] - page / 2) <= F.lit(tolerance) * page)


def crop_size(side: Column, scale: Column) -> Column:
    """Side of a shrunk crop, at least 1; only shrinks.  Halves go to even."""
    return F.greatest(F.lit(1), F.bround(side * F.least(scale, F.lit(1.0)))).cast("int")


def is_blank(ink: Column, dark: Column, pixels: Column, least: Column, most: Column) -> Column:
    """Hardly any ink and nothing dark, or hardly any contrast."""
    return ((ink <= F.greatest(F.lit(2), F.floor(pixels * F.lit(1e-5)))) & (dark <= 0)) | (most - least <= 2)


def branch(path: Column, height_: Column, anywhere: bool = False) -> Column:
    """Which way an image goes: a table if its folder is ``tiles`` (or any folder above it, if ``anywhere``).

    Where only the folder counts, other images go to layout analysis up to a height of 2048 and to plain text beyond.
    """
    folders = F.slice(F.split(path, "/"), F.lit(1), F.size(F.split(path, "/")) - 1)
    if anywhere:
        return F.when(F.array_contains(folders, "tiles"), "table").otherwise("text")
    return F.when(F.element_at(folders, -1) == "tiles", "table").when(height_ <= 2048, "layout").otherwise("ocr")
