"""The strictly validated join of branch results in template order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remap(names: DataFrame, mapping: DataFrame, name: str = "file_name") -> DataFrame:
    """Names replaced where ``mapping`` (old, new) has them."""
    return names.join(mapping, names[name] == mapping["old"], "left").withColumn(name, F.coalesce("new", name)).drop("old", "new")


def problems(template: DataFrame, branches: list[DataFrame], key: str = "file_name") -> DataFrame:
    """(problem, key): template names given twice, results given twice, missing and not asked for.

    Names are counted on both sides in one aggregation, which combines before the shuffle; there is no join.
    """
    sides = [template.select(key, F.lit(True).alias("_asked")), *[b.select(key, F.lit(False).alias("_asked")) for b in branches]]
    asked, given = F.count_if(F.col("_asked")).alias("_n"), F.count_if(~F.col("_asked")).alias("_given")
    counted = reduce(DataFrame.unionByName, sides).groupBy(key).agg(asked, given)
    unmet = lambda n: (F.col(n) == 0) | F.col(key).isNull()  # noqa: E731  # a null name meets no other
    told = [("template_duplicate", F.col("_n") > 1), ("duplicate", F.col("_given") > 1), ("missing", (F.col("_n") > 0) & unmet("_given")), ("extra", (F.col("_given") > 0) & unmet("_n"))]
    found = counted.where(reduce(Column.__or__, [wrong for _, wrong in told])).withColumn("problem", F.explode(F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in told]))))
    return found.select("problem", key)


def combine(template: DataFrame, branches: list[DataFrame], key: str = "file_name", order: str = "ord") -> DataFrame:
    """Results in template order; raises with the offending names before anything is written."""
    found = problems(template, branches, key)
    told = found.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).orderBy("problem").collect()  # four rows at most
    if told:
        raise ValueError("; ".join(f"{r.problem}: {r.n}, first {r.first}" for r in told))
    return ordered(template, branches, key, order)


def ordered(template: DataFrame, branches: list[DataFrame], key: str = "file_name", order: str = "ord") -> DataFrame:
    """The join itself, for input that is known to be valid."""
    results = reduce(DataFrame.unionByName, branches)
    return template.select(key, order).join(results, key).orderBy(order)
