"""Tables as cell relations: parsing HTML, fitting rows to a grid, merging tiles, and rendering."""

from __future__ import annotations

import html as _html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Cells(HTMLParser):
    """Cells (row, column, rowspan, colspan, text, header) of each table of a text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[tuple]] = []
        self.closed = 0
        self._row = -1
        self._column = 0
        self._cell: list | None = None
        self._taken: set[tuple[int, int]] = set()

    def handle_starttag(self, tag, attrs):
        told = dict(attrs)
        if tag == "table":
            self.tables.append([])
            self._row, self._taken = -1, set()
        elif tag == "tr" and self.tables:
            self._row, self._column = self._row + 1, 0
        elif tag in ("td", "th") and self.tables:
            spans = [max(1, int(told.get(k) or 1)) if str(told.get(k) or 1).isdigit() else 1 for k in ("rowspan", "colspan")]
            self._cell = [*spans, [], tag == "th"]
        elif tag == "br" and self._cell:
            self._cell[2].append("<br>")

    def handle_endtag(self, tag):
        if tag == "table":
            self.closed += 1
        elif tag in ("td", "th") and self._cell:
            rows, columns, text, header = self._cell
            while (self._row, self._column) in self._taken:
                self._column += 1
            self.tables[-1].append((max(0, self._row), self._column, rows, columns, "".join(text).strip(), header))
            self._taken |= {(self._row + i, self._column + j) for i in range(rows) for j in range(columns)}
            self._column += columns
            self._cell = None

    def handle_data(self, data):
        if self._cell:
            self._cell[2].append(data)


def parse(text: str) -> tuple[list[tuple], str | None]:
    """(cells, problem) of a text that holds one table.

    Only a missing end of the table is repaired; a cell that isn't closed, or several tables, are problems.
    """
    reader = _Cells()
    reader.feed(text or "")
    reader.close()
    if not reader.tables:
        return [], "no table"
    if len(reader.tables) > 1:
        return [], "several tables"
    if reader._cell:
        return [], "truncated"
    return reader.tables[0], None if reader.closed else "repaired: missing </table>"


CELLS = "row int, column int, rowspan int, colspan int, text string, header boolean"


def parsed(docs: DataFrame, key: str, html: str) -> DataFrame:
    """(key, problem, n_rows, n_columns, cells): the one table of each text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = []
            for k, text in zip(pdf[key], pdf[html], strict=True):
                cells, problem = parse(text)
                rows.append((k, problem, max((c[0] + c[2] for c in cells), default=0), max((c[1] + c[3] for c in cells), default=0), [dict(zip(("row", "column", "rowspan", "colspan", "text", "header"), c, strict=True)) for c in cells]))
            yield pd.DataFrame(rows, columns=[key, "problem", "n_rows", "n_columns", "cells"])

    return docs.select(key, html).mapInPandas(run, f"{key} {kind}, problem string, n_rows int, n_columns int, cells array<struct<{CELLS.replace(' ', ':').replace(',:', ',')}>>")


def matrix(cells: list[tuple]) -> list[list[str]]:
    """Text by row and column; a spanning cell's text stands in its first place."""
    rows = max((c[0] + c[2] for c in cells), default=0)
    columns = max((c[1] + c[3] for c in cells), default=0)
    out = [[""] * columns for _ in range(rows)]
    for r, c, _, _, text, _ in cells:
        out[r][c] = text
    return out


def align(rows: list[list[str]], mask: list[list[bool]]) -> tuple[list[list[str]], list[str]]:
    """Rows of text fitted to a grid whose mask tells the cells that hold ink; (grid, warnings).

    Extra empty rows go, a repeated header goes, two header rows too many fold into one, empty rows and cells come in
    where the mask has none.  Content that has no place is an error.
    """
    height, width, told = len(mask), len(mask[0]) if mask else 0, []
    rows = [list(r) for r in rows]
    blank = lambda r: not any(x.strip() for x in r)
    while len(rows) > height and any(map(blank, rows)):
        rows.pop(next(i for i, r in enumerate(rows) if blank(r)))
        told.append("empty row removed")
    while len(rows) > height and any(r == rows[0] for r in rows[1:]):
        rows.pop(1 + next(i for i, r in enumerate(rows[1:]) if r == rows[0]))
        told.append("repeated header removed")
    if len(rows) == height + 1 and len(rows) > 2 and not all(x.strip() for x in rows[0] + rows[1]) or len(rows) == height + 1 > 2 and len(rows[0]) < len(rows[1]):
        a, b = rows[0], rows[1]
        n = max(len(a), len(b))
        pick = lambda r, i: r[i].strip() if i < len(r) else ""
        rows[:2] = [[x if x == y or not y else f"{x}<br>{y}" if x else y for x, y in ((pick(a, i), pick(b, i)) for i in range(n))]]
        told.append("two-level header merged")
    if len(rows) > height:
        raise ValueError("more non-empty rows than the grid has")
    inked = [any(m) for m in mask]
    while len(rows) < height:
        at = next((i for i in range(height) if not inked[i] and not (i < len(rows) and blank(rows[i]))), len(rows))
        rows.insert(min(at, len(rows)), [])
        told.append("empty row inserted")
    grid = []
    for texts, flags in zip(rows, mask, strict=True):
        texts = list(texts)
        while len(texts) > width and any(not x.strip() for x in texts):
            texts.pop(max(i for i, x in enumerate(texts) if not x.strip()))
        if len(texts) > width:
            raise ValueError("more non-empty cells than the grid has")
        if len(texts) < width:
            full = [x for x in texts if x.strip()]
            places = [i for i, f in enumerate(flags) if f]
            if len(full) == len(places):
                line = [""] * width
                for i, x in zip(places, full, strict=True):
                    line[i] = x
                texts = line
            else:
                texts += [""] * (width - len(texts))
            told.append("empty cells inserted")
        grid.append(texts)
    return grid, told


def aligned(docs: DataFrame, key: str, html: str, mask: str) -> DataFrame:
    """(key, html, warnings, error): each table on its grid."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            rows = []
            for k, text, flags in zip(pdf[key], pdf[html], pdf[mask], strict=True):
                cells, problem = parse(text)
                try:
                    if problem and not problem.startswith("repaired"):
                        raise ValueError(problem)
                    grid, told = align(matrix(cells), [list(map(bool, r)) for r in flags])
                    rows.append((k, render(grid), [*([problem] if problem else []), *told], None))
                except ValueError as error:
                    rows.append((k, None, [], str(error)))
            yield pd.DataFrame(rows, columns=[key, "html", "warnings", "error"])

    return docs.select(key, html, mask).mapInPandas(run, f"{key} {kind}, html string, warnings array<string>, error string")


def render(grid: list[list[str]]) -> str:
    escape = lambda t: _html.escape(t, quote=False).replace("&lt;br&gt;", "<br>")
    return "<table>" + "".join("<tr>" + "".join(f"<td>{escape(t)}</td>" for t in row) + "</tr>" for row in grid) + "</table>"


def empty_table(rows: Column, columns: Column) -> Column:
    """A table of so many empty cells."""
    row = F.concat(F.lit("<tr>"), F.repeat(F.lit("<td></td>"), columns.cast("int")), F.lit("</tr>"))
    return F.concat(F.lit("<table>"), F.repeat(row, rows.cast("int")), F.lit("</table>"))


def soft_places(values: DataFrame, mask: DataFrame, by: list[str]) -> DataFrame:
    """(by, c, text): the n-th value of a row stands at the n-th inked column of its mask."""
    from pyspark.sql import Window

    v = values.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("c"))).select(*by, "n", "text")
    m = mask.where("ink").withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("c"))).select(*by, "n", "c")
    return m.join(v, [*by, "n"], "left").select(*by, "c", "text")


def render_rows(cells: DataFrame, by: str, rows: str = "r", columns: str = "c", text: str = "text") -> DataFrame:
    """(by, html) of cells (by, r, c, text); a table's own cells are gathered in order."""
    td = F.concat(F.lit("<td>"), F.coalesce(text, F.lit("")), F.lit("</td>"))
    ordered = lambda k, v: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(k).alias("k"), v.alias("v")))), lambda x: x["v"]), "")
    lines = cells.groupBy(by, rows).agg(F.concat(F.lit("<tr>"), ordered(columns, td), F.lit("</tr>")).alias("line"))
    return lines.groupBy(by).agg(F.concat(F.lit("<table>"), ordered(rows, F.col("line")), F.lit("</table>")).alias("html"))


def trimmed(cells: DataFrame, by: str) -> DataFrame:
    """Cells (by, r, c, text) without empty outer rows and columns, renumbered from 0."""
    full = cells.where(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy(by).agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    inside = cells.join(full, by).where(F.col("r").between(F.col("r0"), F.col("r1")) & F.col("c").between(F.col("c0"), F.col("c1")))
    return inside.select(by, (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), "text")


def merge_tiles(cells: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Cells (by, tile, row_start, column_start, context_rows, context_columns, r, c, text) at their logical places.

    Returns (by, r, c, text) and (by, covered_cells, conflicts); repeated context goes, and a place that two tiles fill
    differently is a conflict.
    """
    own = cells.where((F.col("r") >= F.col("context_rows")) & (F.col("c") >= F.col("context_columns")))
    placed = own.select(by, (F.col("row_start") + F.col("r") - F.col("context_rows")).alias("r"), (F.col("column_start") + F.col("c") - F.col("context_columns")).alias("c"), "text")
    one = placed.groupBy(by, "r", "c").agg(F.min("text").alias("text"), (F.min("text") != F.max("text")).alias("conflict"))
    told = one.groupBy(by).agg(F.count(F.lit(1)).alias("covered_cells"), F.count_if("conflict").alias("conflicts"))
    return one.select(by, "r", "c", "text"), told


def merge_rows(parts: DataFrame, by: str) -> DataFrame:
    """(by, r, line): Markdown table parts (by, part, r, line) below each other.

    A later part's repeated header and rule go, and its first row if it equals the last row before the seam.
    """
    from pyspark.sql import Window

    head = parts.where((F.col("part") == 0) & (F.col("r") < 2)).select(by, F.col("r").alias("hr"), F.col("line").alias("header"))
    bare = parts.join(head, (parts[by] == head[by]) & (parts["r"] == head["hr"]) & (parts["line"] == head["header"]) & (parts["part"] > 0), "left_anti")
    w = Window.partitionBy(by).orderBy("part", "r")
    seam = F.coalesce((F.col("line") == F.lag("line").over(w)) & (F.col("part") != F.lag("part").over(w)), F.lit(False))
    return bare.withColumn("_seam", seam).where(~F.col("_seam")).select(by, (F.row_number().over(w) - 1).alias("r"), "line")


def merge_columns(parts: DataFrame, by: str) -> DataFrame:
    """(by, r, cells): parts (by, part, r, cells: array) side by side; a column repeated at the seam stays once."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        blocks = [g.sort_values("r")["cells"].map(list).tolist() for _, g in pdf.sort_values("part").groupby("part")]
        out = blocks[0]
        for block in blocks[1:]:
            same = all(a and b and a[-1] == b[0] for a, b in zip(out, block, strict=True))
            out = [a + b[same:] for a, b in zip(out, block, strict=True)]
        return pd.DataFrame({by: pdf[by].iloc[0], "r": range(len(out)), "cells": out})

    kind = parts.schema[by].dataType.simpleString()
    return parts.groupBy(by).applyInPandas(fold, f"{by} {kind}, r int, cells array<string>")


def ink_mask(pixels: DataFrame, by: str, rows: str, columns: str, inset: float = 0.10) -> DataFrame:
    """(by, mask): for each grid cell whether any ink lies in it, leaving out a border of ``inset``.

    ``pixels`` is (by, x, y, ink, rows: boundaries, columns: boundaries).
    """
    from lamina.operators.spans import cell_of

    r, c = cell_of(F.col("y"), F.col(rows)), cell_of(F.col("x"), F.col(columns))
    at = pixels.where("ink").withColumn("r", r).withColumn("c", c).where("r IS NOT NULL AND c IS NOT NULL")
    edge = lambda b, i, k: F.element_at(b, (F.col(i) + k).cast("int"))
    inside = lambda p, b, i: (F.col(p) >= edge(F.col(b), i, 1) + F.lit(inset) * (edge(F.col(b), i, 2) - edge(F.col(b), i, 1))) & (F.col(p) < edge(F.col(b), i, 2) - F.lit(inset) * (edge(F.col(b), i, 2) - edge(F.col(b), i, 1)))
    full = at.where(inside("y", rows, "r") & inside("x", columns, "c")).select(by, "r", "c").distinct()
    found = full.groupBy(by).agg(F.collect_set(F.struct("r", "c")).alias("full"))
    grids = pixels.select(by, rows, columns).distinct().join(found, by, "left")
    cell = lambda i: F.transform(F.sequence(F.lit(0), F.size(columns) - 2), lambda j: F.coalesce(F.exists("full", lambda x: (x["r"] == i) & (x["c"] == j)), F.lit(False)))
    return grids.select(by, F.transform(F.sequence(F.lit(0), F.size(rows) - 2), cell).alias("mask"))


def top_context(box_left: Column, box_top: Column, first_line: Column, left: Column, right: Column, margin: int = 4) -> Column:
    """The band above a grid's first line within its columns; null where nothing is left."""
    bottom = first_line - margin
    return F.when((bottom > box_top) & (right > left), F.struct(left.alias("x1"), box_top.alias("y1"), right.alias("x2"), bottom.alias("y2")))


def with_title(title: Column, table: Column) -> Column:
    """The title once above its table."""
    return F.when(F.coalesce(F.trim(title), F.lit("")) == "", table).otherwise(F.concat_ws("\n\n", title, table))


def is_single_table(text: str) -> bool:
    """Gate for a stored result: one closed table, no leftover fence."""
    cells, problem = parse(text)
    return bool(cells) and problem is None and not re.search(r"```", text)
