"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

Targets are filled like water: sources in code-point order (null last) weigh ``weights`` in turn and share the whole
size; a target stops at ``cap`` times its source's size and the excess goes to the others by weight.

Within a source every document is due ``rate = target / source_size`` copies.  ``floor(rate)`` copies are certain.
For the remaining part each document draws a fixed uniform number ``u`` (a hash of its id and text) and is ranked by
``(u / (1-u)) / (p / (1-p))``: random odds over inclusion odds.  The sample is fixed in words: documents are taken in
rank order until the next would pass what is left of the target; then the one unranked document whose size is nearest
the gap closes it, if that comes nearer.

The rank order is never sorted as a whole.  Ranks lie in (0, 1); sizes are summed over 1024 cells a source, then over
1024 cells of the crossing cell, and only what lies in one cell in 2**20 is put in order, so a source that holds a
third of all rows is cut with partial sums.  The plan's only single-task windows run over one short row a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, others, word_count

CELLS = 1024
#: Decisions are one row a source; they are broadcast up to this many rows (about 100 bytes each), joined beyond it.
BROADCAST_SOURCES = 100_000


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """(source, source_size) -> (source, source_size, target)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    limit = F.lit(cap) * F.col("source_size")
    order = [(limit / F.col("w")).asc(), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        weighted.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
        .withColumn("full", limit <= F.col("level") * F.col("w"))
    )
    first_open = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), limit / F.col("w"))).over(everything)
    return level.select("source", "source_size", F.when(F.col("full"), limit).otherwise(F.least(limit, F.col("w") * first_open)).alias("target"))


def _uniform(seed: int, *keys: Column) -> Column:
    """A number strictly between 0 and 1 that depends on the keys and the seed only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))


def _rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds, mapped to (0, 1) without changing the order."""
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    odds = (u / (1 - u)) / (p / (1 - p))
    return odds / (1 + odds)


def _crossing(rows: DataFrame, cell: Column, by: list[str]) -> DataFrame:
    """The first cell of each source in which the running size passes ``left``, and what is left before it."""
    summed = rows.groupBy(*by, "left", cell.alias("cell")).agg(F.sum("size").alias("size"))
    upto = Window.partitionBy(*by).orderBy("cell")
    run = summed.withColumn("upto", F.sum("size").over(upto))
    return run.where(F.col("upto") > F.col("left")).groupBy(*by).agg(F.min_by("cell", "cell").alias("cell"), F.min_by(F.col("left") - (F.col("upto") - F.col("size")), "cell").alias("left_in"))


def _fits(df: DataFrame, limit: int) -> bool:
    return len(df.limit(limit + 1).select(F.lit(1)).take(limit + 1)) <= limit


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 20240229,
    importance: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents with a struct ``mix`` (size, source_size, target, copies, taken); all columns stay but one named ``mix``.

    ``importance`` names a column of positive weights: a document is then due copies in proportion to it, at most
    ``cap``, so inclusion odds differ within a source (null counts as 1).

    Null text has size 0; null source is a source of its own, last in order; a null id draws by its text.  Documents
    of size 0 are never needed to come near a target but may be taken.  Rows that repeat in id and text draw the same
    number and are taken together.  Empty input gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    size = word_count(F.col(text_col))
    v = F.coalesce(F.col(importance).cast("double"), F.lit(1.0)) if importance else F.lit(1.0)
    u = _uniform(seed, F.col(id_col).cast("string"), F.col(text_col))
    drawn = scratch.table(docs.select(F.col(source_col).alias("source"), size.alias("size"), u.alias("u"), v.alias("v")), "drawn")
    sums = scratch.table(drawn.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("v")).alias("scaled")), "sums")
    targets = scratch.table(source_targets(sums.select("source", "source_size"), weights, float(cap)).join(sums.select(F.col("source").alias("s"), "scaled"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "targets")
    small = _fits(targets, BROADCAST_SOURCES)
    side = (lambda df: F.broadcast(df)) if small else (lambda df: df)

    def due(frame: DataFrame) -> DataFrame:
        """Adds whole copies and rank; a document at the cap has no rank."""
        e = F.least(F.lit(float(cap)), F.coalesce(F.col("target") / F.nullif(F.col("scaled"), F.lit(0.0)), F.lit(0.0)) * F.col("v"))
        return frame.withColumn("e", e).withColumn("whole", F.floor("e")).withColumn("t", F.when(F.col("whole") < cap, _rank(F.col("u"), F.col("e") - F.col("whole"))))

    def with_source(frame: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "of")
        return frame.join(side(right), F.col("source").eqNullSafe(F.col("of"))).drop("of")

    ranked = scratch.table(due(with_source(drawn, targets)).select("source", "size", "whole", "t", "target"), "ranked")
    left = scratch.table(ranked.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("left")), "left")
    pool = with_source(ranked.where("t IS NOT NULL").select("source", "size", "t"), left)
    one = F.floor(F.col("t") * CELLS)
    first = scratch.table(_crossing(pool, one, ["source"]), "first")
    inner = with_source(pool.drop("left"), first).where(one == F.col("cell")).select("source", "size", "t", F.col("cell").alias("c1"), F.col("left_in").alias("left"))
    two = F.least(F.floor(F.col("t") * CELLS * CELLS) - F.col("c1") * CELLS, F.lit(CELLS - 1))
    second = scratch.table(_crossing(inner, two, ["source", "c1"]), "second")
    final = with_source(pool.drop("left"), second).where((one == F.col("c1")) & (F.least(F.floor(F.col("t") * CELLS * CELLS) - F.col("c1") * CELLS, F.lit(CELLS - 1)) == F.col("cell")))
    tied = final.groupBy("source", "c1", "cell", "left_in", "t").agg(F.sum("size").alias("size"))
    run = tied.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("t")))
    within = F.col("upto") <= F.col("left_in")
    cut = scratch.table(
        run.groupBy("source").agg(
            F.coalesce(F.max(F.when(within, F.col("t"))), F.max((F.col("c1") * CELLS + F.col("cell")) / F.lit(float(CELLS * CELLS)))).alias("low"),
            (F.first("left_in") - F.coalesce(F.max(F.when(within, F.col("upto"))), F.lit(0))).alias("gap"),
        ),
        "cut",
    )
    rest = with_source(pool.drop("left"), cut).where(F.col("t") > F.col("low")).groupBy("source", "t", "gap").agg(F.sum("size").alias("size"))
    miss = F.abs(F.col("size") - F.col("gap"))
    closing = rest.where(miss < F.col("gap")).groupBy("source").agg(F.min_by("t", F.struct(miss, F.col("t"))).alias("closing"))
    decided = targets.alias("a").join(cut.withColumnRenamed("source", "cs"), F.col("source").eqNullSafe(F.col("cs")), "left").join(closing.withColumnRenamed("source", "ds"), F.col("source").eqNullSafe(F.col("ds")), "left")
    # A source without a crossing cell takes all that is ranked.
    decided = scratch.table(decided.select("source", "source_size", "target", "scaled", F.coalesce("low", F.lit(1.0)).alias("low"), "closing"), "decided")

    packed = docs.select(F.struct(F.lit(0).alias("__one"), *others(docs, "mix")).alias("row"), F.col(source_col).alias("source"), size.alias("size"), u.alias("u"), v.alias("v"))
    out = due(with_source(packed, decided))
    copies = (F.col("whole") + F.coalesce(((F.col("t") <= F.col("low")) | F.coalesce(F.col("t") == F.col("closing"), F.lit(False))).cast("long"), F.lit(0))).cast("long")
    out = out.withColumn("copies", copies)
    return out.select("row.*", F.struct("size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")).alias("mix")).drop("__one")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents repeated as often as the mix takes them, with the columns they came with."""
    named = (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), *[F.col(f"`{options.pop(k, d)}`").alias(d) for k, d in named])
    taken = mix(packed, **options).where("mix.copies > 0")
    return taken.select("kept", F.explode(F.array_repeat(F.lit(1), F.col("mix.copies").cast("int")))).select("kept.*")
