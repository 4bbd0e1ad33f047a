"""Planners of windows, patches and tiles; each turns one row into its generated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def detection_windows(pages: DataFrame, key: str, height: str, window: int = 2048, stride: int = 1792) -> DataFrame:
    """(key, window_index, start_y, end_y, ownership_start_y, ownership_end_y).

    Windows start every ``stride`` and the last ends at the page's end; a page no taller than a window has one.  The
    overlap of neighbours belongs to each up to its middle.
    """
    h = F.col(height).cast("long")
    last = F.greatest(h - window, F.lit(0))
    regular = F.filter(F.sequence(F.lit(0).cast("long"), last, F.lit(stride).cast("long")), lambda s: s < last)
    starts = F.concat(regular, F.array(last))
    rows = pages.select(key, h.alias("h"), starts.alias("starts")).select("*", F.posexplode("starts").alias("window_index", "start_y"))
    return _owned(rows, key, F.lit(window), "window_index", "start_y", "end_y", "ownership_start_y", "ownership_end_y")


def _owned(rows: DataFrame, key: str, size: Column, index: str, start: str, end: str, own_start: str, own_end: str, to_even: bool = False) -> DataFrame:
    """Ends and ownership from the row's own array of starts: no window over pages is needed."""
    i, n = F.col(index), F.size("starts")
    stop = lambda at: F.least(at + size, F.col("h"))
    middle = (lambda a, b: F.bround((a + b) / 2).cast("long")) if to_even else (lambda a, b: F.floor((a + b) / 2))
    before, after = F.element_at("starts", F.greatest(i, F.lit(1))), F.element_at("starts", F.least(i + 2, n))
    return rows.select(
        key,
        index,
        start,
        stop(F.col(start)).alias(end),
        F.when(i == 0, F.lit(0).cast("long")).otherwise(middle(F.col(start), stop(before))).alias(own_start),
        F.when(i == n - 1, F.col("h")).otherwise(middle(stop(F.col(start)), after)).alias(own_end),
    )


def axis_starts(length: Column, most: int, overlap: int) -> tuple[Column, Column]:
    """(starts, size) of equal spans of at most ``most`` with ``overlap`` between neighbours; one span if it fits."""
    if not 0 <= overlap < most:
        raise ValueError("0 <= overlap < most is needed")
    length = length.cast("long")
    count = F.when(length <= most, F.lit(1).cast("long")).otherwise(F.greatest(F.lit(2).cast("long"), F.ceil((length - overlap) / F.lit(most - overlap))))
    size = F.when(length <= most, length).otherwise(F.ceil((length + (count - 1) * overlap) / count))
    starts = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.when((i == count - 1), length - size).otherwise(i * (size - overlap)))
    return starts, size


def axis_spans(items: DataFrame, key: str, length: str, most: int, overlap: int, prefix: str = "") -> DataFrame:
    """(key, index, start, end, own_start, own_end) along one axis; halves of an overlap are rounded to even."""
    starts, size = axis_starts(F.col(length), most, overlap)
    rows = items.select(key, F.col(length).cast("long").alias("h"), starts.alias("starts"), size.alias("size")).select("*", F.posexplode("starts").alias("index", "start"))
    out = _owned(rows, key, F.col("size"), "index", "start", "end", "own_start", "own_end", to_even=True)
    return out.select(key, *[F.col(c).alias(prefix + c) for c in ("index", "start", "end", "own_start", "own_end")])


def patches(images: DataFrame, key: str, width: str, height: str, most: int = 2000, overlap: int = 160) -> DataFrame:
    """Patches of both axes with the part of the image that each owns."""
    x = axis_spans(images, key, width, most, overlap, "x_")
    y = axis_spans(images, key, height, most, overlap, "y_")
    return x.join(y, key)


def owner_index(position: Column, length: Column, most: int, overlap: int) -> Column:
    """Index of the span that owns a position: a division, corrected by at most one."""
    length = length.cast("long")
    count = F.greatest(F.lit(2).cast("long"), F.ceil((length - overlap) / F.lit(most - overlap)))
    size = F.ceil((length + (count - 1) * overlap) / count)
    stride = size - overlap
    start = lambda i: F.when(i == count - 1, length - size).otherwise(i * stride)
    edge = lambda i: F.bround((start(i) + start(i - 1) + size) / 2)
    guess = F.least(count - 1, F.greatest(F.lit(0).cast("long"), F.floor((2 * position - size + stride) / (2 * stride))))

    def corrected(g: Column) -> Column:
        up, down = (g + 1 < count) & (position >= edge(g + 1)), (g > 0) & (position < edge(g))
        return g + F.when(up, 1).when(down, -1).otherwise(0)

    return F.when(length <= most, F.lit(0).cast("long")).otherwise(F.transform(F.array(guess), corrected)[0])


def pixel_tiles(images: DataFrame, key: str, width: str, height: str, most: int = 3900, overlap: int = 160) -> DataFrame:
    """Tiles at native scale: the fewest rows and columns that fit; neighbours overlap by at most ``overlap``."""

    def axis(name: str, index: str, start: str, end: str, frame: DataFrame) -> DataFrame:
        length = F.col(name).cast("long")
        count = F.ceil(length / F.lit(most))
        shared = F.when(count > 1, F.least(F.lit(overlap).cast("long"), F.floor((count * most - length) / (count - 1)))).otherwise(F.lit(0).cast("long"))
        size = F.ceil((length + (count - 1) * shared) / count)
        starts = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda i: F.least(i * (size - shared), length - size))
        return frame.select("*", F.posexplode(starts).alias(index, start)).withColumn(end, F.least(F.col(start) + size, length))

    out = axis(width, "column_index", "x1", "x2", axis(height, "row_index", "y1", "y2", images.select(key, width, height)))
    return out.select(key, "row_index", "column_index", "x1", "y1", "x2", "y2")


def seams(tiles: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Ownership between overlapping neighbours: the seam lies in the middle of the overlap."""
    w = Window.partitionBy(*by).orderBy(start)
    before, after = F.lag(end).over(w), F.lead(start).over(w)
    return tiles.withColumn("own_start", F.coalesce(F.floor((before + F.col(start)) / 2), F.col(start))).withColumn("own_end", F.coalesce(F.floor((F.col(end) + after) / 2), F.col(end)))


def grid_tiles(grids: DataFrame, key: str, rows: str, columns: str, max_side: int = 3900, max_cells: int = 140, preferred: int = 80, aspect: float = 8.0) -> DataFrame:
    """(key, row_start, row_end, column_start, column_end): tiles cut at grid boundaries only.

    ``rows`` and ``columns`` are arrays of boundaries.  Cuts are as even as they can be.  Of all numbers of row and
    column parts, those whose tiles pass the limits are ranked: tiles of ``preferred`` cells or more, fewest tiles, the
    squarest.  No rows where not even single cells fit.
    """
    import pandas as pd

    def cuts(edges, parts):
        n = len(edges) - 1
        return [round(i * n / parts) for i in range(parts + 1)]

    def plan(batches):
        for pdf in batches:
            out = []
            for k, r, c in zip(pdf[key], pdf[rows], pdf[columns], strict=True):
                r, c, best = list(r), list(c), None
                sides = {}
                for edges, name in ((r, "r"), (c, "c")):
                    for parts in range(1, len(edges)):
                        at = cuts(edges, parts)
                        sizes = [edges[b] - edges[a] for a, b in zip(at, at[1:], strict=False)]
                        if max(sizes) <= max_side:
                            sides[name, parts] = at, max(sizes), min(sizes), max(b - a for a, b in zip(at, at[1:], strict=False)), min(b - a for a, b in zip(at, at[1:], strict=False))
                for (name, i), row in sides.items():
                    for (other, j), col in sides.items():
                        if name != "r" or other != "c" or row[3] * col[3] > max_cells:
                            continue
                        ratio = max(row[1] / max(1, col[2]), col[1] / max(1, row[2]))
                        few = i * j > 1 and row[4] * col[4] < preferred
                        score = (ratio > aspect, few, i * j, ratio, i)
                        if best is None or score < best[0]:
                            best = score, row[0], col[0]
                if best:
                    out += [(k, a, b, x, y) for a, b in zip(best[1], best[1][1:], strict=False) for x, y in zip(best[2], best[2][1:], strict=False)]
            yield pd.DataFrame(out, columns=[key, "row_start", "row_end", "column_start", "column_end"])

    kind = grids.schema[key].dataType.simpleString()
    return grids.select(key, rows, columns).mapInPandas(plan, f"{key} {kind}, row_start int, row_end int, column_start int, column_end int")


def fixed_slices(images: DataFrame, key: str, height: str, chunk: int = 2048, overlap: int = 256, tail: int = 512) -> DataFrame:
    """(key, index, start_y, end_y): fixed slices; a tail under ``tail`` joins the slice before it.  Nothing is lost."""
    step, h = chunk - overlap, F.col(height).cast("long")
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), h - overlap - 1), F.lit(step).cast("long"))
    keep = F.filter(starts, lambda s: (s == 0) | (h - s >= tail))
    rows = images.where(h > 0).select(key, h.alias("h"), keep.alias("starts")).select("*", F.posexplode("starts").alias("index", "start_y"))
    return rows.select(key, "index", "start_y", F.when(F.col("index") == F.size("starts") - 1, F.col("h")).otherwise(F.least(F.col("start_y") + chunk, F.col("h"))).alias("end_y"))


def chunk_order(name: Column) -> Column:
    """Number of a chunk's file; names without one come last."""
    return F.coalesce(F.when(name.rlike(r"_\d+\."), F.regexp_extract(name, r"_(\d+)\.", 1).cast("int")), F.lit(999999))


def centre_cell(x: Column, y: Column, scale: Column, origin_x: Column, origin_y: Column, context_width: Column, context_height: Column) -> Column:
    """Source position of a box centre in a request image, null where it lies in repeated context."""
    inside = (x >= context_width) & (y >= context_height)
    return F.when(inside, F.struct((origin_x + (x - context_width) / scale).alias("x"), (origin_y + (y - context_height) / scale).alias("y")))


def cell_of(position: Column, boundaries: Column) -> Column:
    """Index of the half-open cell that holds a position, null outside."""
    at = F.size(F.filter(boundaries, lambda b: b <= position)) - 1
    return F.when((at >= 0) & (at < F.size(boundaries) - 1), at)
