"""Packing documents into token sequences by the sum-of-squares rule.

Documents are encoded where they lie; only one short row a piece is shuffled.  Pieces are dealt by hash into groups
of about ``GROUP`` pieces and each group is packed by itself, so the work is in proportion to the input at any size and
a group loses no more than a few partly filled sequences among tens of thousands.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import encoder

GROUP = 60_000
PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length its bin and its offset there.

    ``open_bins[g]`` is the number of open bins with a gap of g.  A piece goes where the sum of their squares becomes
    smallest: putting length s into a bin of gap g lowers N(g) and raises N(g - s), which changes the sum by
    2 * (N(g - s) - N(g)) + 2, or by 1 - 2 * N(s) where the bin becomes full.  Ties go to the tightest gap.  As all
    pieces are known, they come longest first, and a bin is opened only where no open one has room.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins = np.zeros(size + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    n, far = 0, np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        here = open_bins[s:size]
        gap = size
        if here.any():
            change = np.where(here > 0, 2 * (open_bins[: size - s] - here) + 2, far)
            change[0] -= here[0] > 0
            gap = s + int(change.argmin())
        if gap == size:
            b, n = n, n + 1
        else:
            b = by_gap[gap].pop()
            open_bins[gap] -= 1
        bins[i], offsets[i] = b, size - gap
        if gap > s:
            by_gap[gap - s].append(b)
            open_bins[gap - s] += 1
    return bins, offsets


def pieces(docs: DataFrame, vocabulary: str, size: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document's ids followed by ``separator``.

    Only documents longer than ``size`` are cut; all pieces but the first are then full.  Null text is empty: one
    piece that is the separator.
    """

    def run(batches):
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.append(encode([text.as_py() or ""])[0], np.uint32(separator)).astype("<u4")
                first = len(ids) if len(ids) <= size else len(ids) % size or size
                edges = [0, *range(first, len(ids) + 1, size)]
                rows += [(key.as_py(), k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, separator: int = 0, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    Pieces of a sequence lie in it without gaps from offset 0.  Null text packs its separator alone; repeated rows and
    null ids are packed each; an empty table gives no rows.  Reruns give the same sequences.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    cut = scratch.table(pieces(docs, vocabulary, size, separator, id_col, text_col), "pieces")
    n_groups = -(-cut.count() // group) or 1
    key = F.pmod(F.xxhash64(F.lit(7), "id", "piece", "ids_crc32", "length"), F.lit(n_groups))

    def place(pdf):
        pdf = pdf.sort_values(["id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offsets = sum_of_squares(pdf["length"].to_numpy(), size)
        pdf["sequence_id"], pdf["offset"] = pdf["part"].to_numpy() * (1 << 32) + bins, offsets
        return pdf[["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return cut.withColumn("part", key).groupBy("part").applyInPandas(place, f"{PIECES}, sequence_id long, offset long")
