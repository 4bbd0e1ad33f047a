"""Exact duplicates by content hash, and overlapping boxes.

Groups are formed by aggregation, so copies collapse before the shuffle; the canonical row comes back by an equi-join,
which adaptive execution splits where one content is very frequent.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.keys import content_hash

#: Fixed value: boxes of a group that is suppressed beside others of its size.
SMALL = 64


def groups(items: DataFrame, content: Column, key: str) -> DataFrame:
    """(sha256, n, canonical, last): one row a content; the smallest key is canonical."""
    return items.groupBy(content_hash(content).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("canonical"), F.max(key).alias("last"))


def report(items: DataFrame, content: Column, key: str, by: str) -> DataFrame:
    """Per ``by``: rows, distinct contents, rows that could be reused, and groups of more than one."""
    sizes = items.groupBy(by, content_hash(content).alias("sha256")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(by).agg(
        F.sum("n").alias("image_count"),
        F.count(F.lit(1)).alias("unique_image_count"),
        (F.sum("n") - F.count(F.lit(1))).alias("reusable_count"),
        F.count_if(F.col("n") > 1).alias("duplicate_groups"),
    )


def fan_out(items: DataFrame, content: Column, key: str) -> DataFrame:
    """(key, canonical, sha256): each row with the row whose result it shares."""
    hashed = items.select(key, content_hash(content).alias("sha256"))
    least = hashed.groupBy("sha256").agg(F.min(key).alias("canonical"))
    return hashed.join(least, "sha256").select(key, "canonical", "sha256")


def dominated_pairs(boxes: DataFrame, by: list[str], overlap: float, cell: int) -> DataFrame:
    """(by, id, stronger): pairs of a label whose IoU passes ``overlap``, the weaker first.

    Boxes meet only in a shared grid cell of ``cell`` units, so the join is an equi-join.
    """
    from lamina.functions.boxes import box, iou

    b = box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"))
    spread = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor((F.greatest(F.col(hi), F.col(lo) + 1) - 1) / cell))
    cells = boxes.select(*by, "id", "confidence", b.alias("b"), F.explode(spread("x1", "x2")).alias("cx"), spread("y1", "y2").alias("ys")).withColumn("cy", F.explode("ys")).drop("ys")
    left, right = cells.alias("l"), cells.alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*by, "cx", "cy")]
    weaker = (F.col("l.confidence") < F.col("r.confidence")) | ((F.col("l.confidence") == F.col("r.confidence")) & (F.col("l.id") > F.col("r.id")))
    hit = left.join(right, [*same, F.col("l.id") != F.col("r.id")]).where(weaker & (iou(F.col("l.b"), F.col("r.b")) > overlap))
    return hit.select(*[F.col(f"l.{k}").alias(k) for k in by], F.col("l.id").alias("id"), F.col("r.id").alias("stronger")).distinct()


def suppress(boxes: DataFrame, by: list[str], overlap: float = 0.5) -> DataFrame:
    """Greedy suppression: the strongest box stays, boxes of its label that overlap it go, and so on.

    What a box suppresses depends on the boxes kept before it, so each ``by`` group (an image's label) is one fold; sorted
    partitions are streamed, and many small groups share a batch.  Groups of at most ``SMALL`` boxes go through the fold
    side by side, as rows of a matrix as wide as the largest of them.
    """
    import numpy as np

    def over(a, b):
        """Whether boxes a and b (four arrays each, which broadcast) overlap too much."""
        sizes = [np.maximum(0, x2 - x1) * np.maximum(0, y2 - y1) for x1, y1, x2, y2 in (a, b)]
        common = np.maximum(0, np.minimum(a[2], b[2]) - np.maximum(a[0], b[0])) * np.maximum(0, np.minimum(a[3], b[3]) - np.maximum(a[1], b[1]))
        union = sizes[0] + sizes[1] - common
        return np.divide(common, union, out=np.zeros_like(common), where=union > 0) > overlap

    def survivors(b):
        """Which boxes of groups of one width stay; ``b`` is (4, groups, width)."""
        stay = np.ones(b.shape[1:], bool)
        for i in range(b.shape[2] - 1):
            live = np.flatnonzero(stay[:, i])
            if len(live):
                stay[live, i + 1 :] &= ~over(b[:, live, i : i + 1], b[:, live, i + 1 :])
        return stay

    def kept(whole):
        group = _groups(whole, by)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        sizes, b = np.diff(starts, append=len(group)), np.stack([whole[c].to_numpy(float) for c in ("x1", "y1", "x2", "y2")])
        stay = np.ones(len(group), bool)
        for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            stay[start : start + size] = survivors(b[:, None, start : start + size])[0]
        for width in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
            at = starts[sizes == width][:, None] + np.arange(width)
            stay[at] = survivors(b[:, at])
        return whole[stay]

    def keep(batches):
        open_ = []  # pieces of a group that may go on in the next batch
        for pdf in batches:
            if not len(pdf):
                continue
            group = _groups(pdf, by)
            last = int(np.searchsorted(group, group[-1]))
            if open_ and (last > 0 or _groups(pd.concat([open_[-1].tail(1), pdf.head(1)], ignore_index=True), by)[-1]):
                yield kept(pd.concat([*open_, pdf[:last]], ignore_index=True))
                open_ = []
            elif last:
                yield kept(pdf[:last])
            open_.append(pdf[last:])
        if open_:
            yield kept(pd.concat(open_, ignore_index=True))

    ordered = boxes.repartition(*by).sortWithinPartitions(*by, F.desc("confidence"), "id")
    return ordered.mapInPandas(keep, boxes.schema)


def _groups(rows: pd.DataFrame, by: list[str]):
    """Numbers of sorted rows' groups, from 0; null is a group."""
    return rows.groupby(by, sort=False, dropna=False).ngroup().to_numpy()
