"""The recogniser stage: a pluggable model over the distinct work that the cache misses, with retries and policies.

Failures are columns of a row, never exceptions of the job; the policies decide afterwards what becomes of them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.keys import retry_delay
from lamina.operators.cache import misses, upsert
from lamina.operators.tables import empty_table


class Temporary(RuntimeError):
    """Worth another attempt."""


class Empty(Temporary):
    """The model answered with nothing."""


class Permanent(RuntimeError):
    """Another attempt would fail the same way."""


RESULT = "result string, error string, attempts int"


def attempt(call: Callable[[], str], retries: int = 15, empty_retries: int = 3, blank_ok: bool = False) -> tuple[str | None, str | None, int]:
    """(result, error, attempts): temporary errors are tried again, empty answers within a budget of their own."""
    empty = 0
    for n in range(1, min(retries, 15) + 2):
        try:
            return call(), None, n
        except Empty:
            empty += 1
            if empty > empty_retries:
                return ("", None, n) if blank_ok else (None, "empty", n)
        except Temporary as error:
            last = f"temporary: {error}"
            if n == min(retries, 15) + 1:
                return None, last, n
        except Exception as error:
            return None, f"permanent: {error}", n
    return None, "empty", n


def run_model(work: DataFrame, keys: list[str], factory: Callable[[], Callable[[dict], str]], **options) -> DataFrame:
    """(keys, result, error, attempts): the model made by ``factory`` in each worker, over every row of ``work``."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in work.select(*keys).schema)

    def run(batches):
        model = None
        for pdf in batches:
            model = model or factory()
            rows = [attempt(lambda r=r: model(r), **options) for r in pdf.to_dict("records")]
            yield pd.concat([pdf[keys].reset_index(drop=True), pd.DataFrame(rows, columns=["result", "error", "attempts"])], axis=1)

    return work.mapInPandas(run, f"{schema}, {RESULT}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` from a table written once to the folder that the cluster shares (its checkpoint folder)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lamina-"))
    path = f"{sc._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark, folder: str) -> bool:
    """Whether a folder is there, in whatever file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def recognise(work: DataFrame, cache: DataFrame, keys: list[str], factory, skip: Column | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """(results of all keys, the cache with new results): distinct keys that miss run once, blank ones not at all.

    A null ``skip`` doesn't skip.  Failed results aren't stored; an empty one that was confirmed is, so it isn't asked
    for again.  New results are written before they are used, so reading both tables runs the model once.
    """
    todo = misses(work.dropDuplicates(keys), cache, keys)
    blank = F.coalesce(skip, F.lit(False)) if skip is not None else F.lit(False)
    made = run_model(todo.where(~blank), keys, factory, **options)
    none = todo.where(blank).select(*keys, F.lit("").alias("result"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"))
    new = written(made.unionByName(none), "recognised")
    stored = upsert(cache, new.where("error IS NULL").select(*keys, "result", F.current_timestamp().alias("created_at")), keys, ["created_at"])
    known = cache.select(*keys, "result", F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"))
    return known.join(work.select(*keys).distinct(), keys, "left_semi").unionByName(new), stored


def continued(items: DataFrame, error: str) -> tuple[DataFrame, DataFrame]:
    """(items that were prepared, failures): one failure doesn't stop the others."""
    return items.where(F.col(error).isNull()).drop(error), items.where(F.col(error).isNotNull())


def loaded(name: str):
    """The factory that ``module:name`` tells: of a recogniser, an OCR engine or a layout detector."""
    from importlib import import_module

    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"module:factory is needed, not {name}")
    return getattr(import_module(module), attribute)


#: Fields of what detectors and OCR engines find.
BOXES = "label string, text string, confidence double, x1 double, y1 double, x2 double, y2 double"


def detect(images: DataFrame, keys: list[str], factory: Callable[[], Callable[[dict], list[tuple]]]) -> DataFrame:
    """(keys, label, text, confidence, box) that an OCR engine or a layout detector finds in every row of ``images``.

    The engine is made by ``factory`` in each worker when it meets its first row; it gives a list of boxes a row.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in images.select(*keys).schema)
    names = [*keys, *(x.split()[0] for x in BOXES.split(", "))]

    def run(batches):
        engine = None
        for pdf in batches:
            rows = pdf.to_dict("records")
            engine = engine or (factory() if rows else None)
            yield pd.DataFrame([(*(r[k] for k in keys), *box) for r in rows for box in engine(r)], columns=names)

    return images.mapInPandas(run, f"{schema}, {BOXES}")


#: Table detectors by name; each takes a relation of its own evidence.
DETECTORS: dict[str, Callable] = {}


def detector(name: str) -> Callable:
    """A table detector; ``auto`` takes ink regions, and other names those that are registered."""
    from lamina.operators import bands

    known = {"ink": bands.ink_regions, "projection": bands.projected_tables, "auto": bands.ink_regions} | DETECTORS
    if name not in known:
        raise ValueError(f"no table detector {name}; there are {', '.join(sorted(known))}")
    return known[name]


def retry_schedule(attempts: DataFrame, n: str = "attempt") -> DataFrame:
    """Each attempt with its delay and what has passed by then."""
    from pyspark.sql import Window

    return attempts.withColumn("delay", retry_delay(F.col(n))).withColumn("elapsed", F.sum("delay").over(Window.orderBy(n)))


def outcomes(attempts: DataFrame, by: list[str], n: str, failed: Column, most: int = 16) -> DataFrame:
    """(by, attempts, succeeded): the first success within ``most`` attempts of each request."""
    done = attempts.where(F.col(n) <= most).groupBy(*by).agg(F.min(F.when(~failed, F.col(n))).alias("first"), F.max(n).alias("last"))
    return done.select(*by, F.coalesce("first", "last").alias("attempts"), F.col("first").isNotNull().alias("succeeded"))


def failure_report(tiles: DataFrame, by: str, part: str, error: str) -> DataFrame:
    """(by, parts, failure_count, failed_parts, status): what failed of each image; its other parts count."""
    failed = F.col(error).isNotNull()
    told = tiles.groupBy(by).agg(F.count(F.lit(1)).alias("parts"), F.count_if(failed).alias("failure_count"), F.array_sort(F.collect_list(F.when(failed, F.col(part)))).alias("failed_parts"))
    status = F.when(F.col("failure_count") == 0, "success").when(F.col("failure_count") < F.col("parts"), "degraded").otherwise("failed")
    return told.withColumn("status", status)


def complete(tiles: DataFrame, result: str, error: str, rows: Column, columns: Column, strict: bool = False) -> DataFrame:
    """Failed tiles become blank tables; in strict mode the first failure raises when the result is used."""
    fallback = F.raise_error(F.concat(F.lit("recognition failed: "), F.col(error))).cast("string") if strict else empty_table(rows, columns)
    return tiles.withColumn(result, F.when(F.col(error).isNotNull(), fallback).otherwise(F.when(F.col(result) == "", empty_table(rows, columns)).otherwise(F.col(result))))


def with_optional_title(images: DataFrame, titles: DataFrame, key: str) -> DataFrame:
    """A title that failed or is missing is empty, with a warning; a later success has none."""
    joined = images.join(titles.select(key, F.col("result").alias("title"), F.col("error").alias("warning")), key, "left")
    return joined.withColumn("title", F.coalesce("title", F.lit("")))


def gate(failed: Column, forced: Column) -> Column:
    """Recognition starts only where preparing had no failure, or is forced; forced runs aren't merged."""
    return F.when(failed == 0, "run").when(forced, "run_without_merge").otherwise("stop")


def is_valid_result(markdown: Column, prompt: Column | None = None) -> Column:
    """Gate on writing and reading the cache: closed HTML, one table, no fence loops, no blow-up, no prompt echo."""
    opened, closed = F.regexp_count(markdown, F.lit("(?i)<table")), F.regexp_count(markdown, F.lit("(?i)</table>"))
    fences = F.regexp_count(markdown, F.lit("```"))
    repeated = markdown.rlike(r"(?s)(.{20,200})\1{8,}")
    ok = (opened == closed) & (opened <= 1) & (fences <= 2) & ~repeated & (F.length(markdown) <= 200_000)
    return F.coalesce(ok & (~F.contains(markdown, F.substring(prompt, 1, 40)) if prompt is not None else F.lit(True)), F.lit(False))


def resumed(items: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Items with ``preprocessing_cache``: reused where the manifest has (content, configuration), else new."""
    known = manifest.select(*keys).distinct().withColumn("_known", F.lit(True))
    return items.join(known, keys, "left").withColumn("preprocessing_cache", F.when(F.col("_known"), "reused").otherwise("new")).drop("_known")
