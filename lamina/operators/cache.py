"""A cache of results as relations: get, upsert, insert-or-ignore, delete, merge, recovery of raw answers.

Precedence is decided by ``max_by`` / ``min_by`` over a struct, which combines before the shuffle, so a key with very
many versions needs no large window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hits(work: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """Work whose key is stored; an empty result counts."""
    return work.join(cache.select(*keys).distinct(), keys, "left_semi")


def misses(work: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    return work.join(cache.select(*keys).distinct(), keys, "left_anti")


def lookup(work: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """All work with the stored columns; null is a miss and "" a hit."""
    return work.join(cache, keys, "left")


def latest(versions: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last version of each key."""
    rest = [c for c in versions.columns if c not in keys]
    return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("v")).select(*keys, "v.*")


def upsert(cache: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert or replace: the later write of a key wins."""
    return latest(cache.unionByName(new), keys, order)


def delete(cache: DataFrame, corrupt: DataFrame, keys: list[str]) -> DataFrame:
    return misses(cache, corrupt, keys)


def merge(destination: DataFrame, sources: list[DataFrame], keys: list[str], created: str) -> DataFrame:
    """Existing rows first, then earlier sources, in each the newest; ``origin`` says which one it was."""
    stacked = [destination.withColumn("origin", F.lit(0))] + [s.withColumn("origin", F.lit(i + 1)) for i, s in enumerate(sources)]
    union = reduce(DataFrame.unionByName, stacked)
    rest = [c for c in union.columns if c not in keys]
    newest_first = F.struct(-F.col("origin"), F.col(created))
    return union.groupBy(*keys).agg(F.max_by(F.struct(*rest), newest_first).alias("v")).select(*keys, "v.*")


def signatures_match(found: dict[str, Column], wanted: dict[str, Column]) -> Column:
    """All present and equal; an absent one doesn't match."""
    return F.coalesce(reduce(lambda a, b: a & b, [found[k] == wanted[k] for k in wanted]), F.lit(False))


def recover(attempts: DataFrame, wanted: DataFrame, keys: list[str], names: tuple[str, ...] = ("tile_sha256", "prompt_sha256", "cache_key", "model")) -> DataFrame:
    """The newest stored attempt of each key whose signatures all match those wanted."""
    number = F.regexp_extract("name", r"attempt_(\d+)", 1).try_cast("int")
    asked = wanted.select(*keys, *[F.col(n).alias(f"want_{n}") for n in names])
    matched = attempts.join(asked, keys).where(signatures_match({n: F.col(n) for n in names}, {n: F.col(f"want_{n}") for n in names}))
    rest = [c for c in attempts.columns if c not in keys]
    return matched.groupBy(*keys).agg(F.max_by(F.struct(*rest), number).alias("v")).select(*keys, "v.*")


def with_legacy(cache: DataFrame, key: str, variants: list[Column]) -> DataFrame:
    """Each row under its present key and under former ones; ``priority`` 0 is the present."""
    return cache.select("*", F.posexplode(F.array(F.col(key), *variants)).alias("priority", "known_as"))
