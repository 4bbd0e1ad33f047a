"""python -m lamina COMMAND: the engine's jobs over folders and files that Spark can read."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.config import LongConfig, TableConfig
from lamina.operators import dedup, merge, recognise, spans, submit
from lamina.sources import images, submission


def hash_report(spark: SparkSession, folder: str) -> DataFrame:
    """Images, distinct contents and reusable copies of a folder."""
    return dedup.report(images.scan(spark, folder).withColumn("folder", F.lit(folder)), F.col("content"), "path", "folder")


def _distinct(spark: SparkSession, folder: str) -> DataFrame:
    found = images.scan(spark, folder).withColumn("h", images.header(F.col("content")))
    return found.groupBy("sha256").agg(F.min("file_name").alias("canonical"), F.array_sort(F.collect_list("file_name")).alias("file_names"), F.first("h").alias("h")).select("sha256", "canonical", "file_names", "h.*")


def unreadable(distinct: DataFrame) -> DataFrame:
    """Images whose header tells no size, as failure rows: they are reported, and the others go on."""
    return distinct.where("height IS NULL OR width IS NULL").select("sha256", "file_names", F.coalesce("format", F.lit("unknown format")).alias("format"), F.lit("the header tells no size").alias("error"))


def prepare_long(distinct: DataFrame, config: LongConfig) -> DataFrame:
    """Detection windows of each distinct tall image."""
    return spans.detection_windows(distinct.where("height IS NOT NULL AND width IS NOT NULL"), "sha256", "height", config.window_height, config.window_stride)


def prepare_tables(distinct: DataFrame, config: TableConfig) -> DataFrame:
    """Tiles of each distinct table image at native scale."""
    return spans.pixel_tiles(distinct.where("height IS NOT NULL AND width IS NOT NULL"), "sha256", "width", "height", config.max_side, config.overlap)


def run_plan(spark: SparkSession, folder: str, plan: str, out: str, model: str, cache: str, branch: str) -> None:
    """Recognise what was prepared, through a cache that lasts, and write one result a file name.

    ``model`` is a plug-in (module:factory) that gets the rows of ``plan`` with their image's content.  Parts of a long
    image are merged at their seams; tiles of a table stay in their order, each on its own.
    """
    parts = spark.read.parquet(plan)
    order = "window_index" if branch == "long" else "tile"
    if branch == "tables":
        parts = parts.withColumn("tile", F.col("row_index") * 10_000 + F.col("column_index"))
    files = images.scan(spark, folder).select("sha256", "file_name", "content")
    content = files.groupBy("sha256").agg(F.first("content").alias("content"))
    work, keys = parts.join(content, "sha256"), ["sha256", order, "config_digest"]
    kind = {f.name: f.dataType.simpleString() for f in parts.schema}
    schema = ", ".join(f"{k} {kind[k]}" for k in keys) + ", result string, created_at timestamp"
    stored = spark.read.schema(schema).parquet(cache) if recognise.exists(spark, cache) else spark.createDataFrame([], schema)
    done, _ = recognise.recognise(work, stored, keys, recognise.loaded(model))
    kept, failed = recognise.continued(done, "error")
    fresh = kept.join(stored.select(*keys), keys, "left_anti")
    fresh.select(*keys, "result", F.current_timestamp().alias("created_at")).write.mode("append").parquet(cache)
    failed.write.mode("overwrite").parquet(f"{out}-failures")
    ordered = kept.select("sha256", F.col(order).alias("n"), F.col("result").alias("markdown"), F.lit(int(branch == "long")).alias("overlap_top"))
    texts = merge.merged(ordered, "sha256", ["n"])
    results = files.select("sha256", "file_name").join(texts, "sha256", "left").select("file_name", F.coalesce("markdown", F.lit("")).alias("ground_truth"))
    results.orderBy("file_name").coalesce(1).write.mode("overwrite").options(header=True, quote='"', escape='"', quoteAll=True).csv(out)


def combine(spark: SparkSession, template: str, branches: list[str], out: str) -> None:
    """Branch results in the template's order, as one file."""
    from pyspark.sql import Window

    names = submission.read(spark, template).select("file_name").withColumn("_at", F.monotonically_increasing_id())
    ordered = names.withColumn("ord", F.row_number().over(Window.orderBy("_at"))).drop("_at")
    joined = submit.combine(ordered, [submission.read(spark, b) for b in branches])
    joined.select(*submission.COLUMNS).coalesce(1).write.mode("overwrite").options(header=True, quote='"', escape='"', quoteAll=True).csv(out)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lamina", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("hash-report", "prepare-long", "prepare-tables"):
        one = commands.add_parser(name)
        one.add_argument("folder")
        one.add_argument("out")
        one.add_argument("--config", help="JSON text")
    for name in ("run-long", "run-tables", "run-local-long", "run-local-tables"):
        one = commands.add_parser(name)
        for field in ("folder", "plan", "out"):
            one.add_argument(field)
        one.add_argument("--model", required=True, help="module:factory; a local one or a client of a service")
        one.add_argument("--cache", required=True, help="folder of stored results")
    both = commands.add_parser("combine-submissions")
    both.add_argument("template")
    both.add_argument("branches", nargs="+")
    both.add_argument("--out", required=True)
    told = parser.parse_args(args)
    spark = SparkSession.builder.appName(f"lamina {told.command}").getOrCreate()
    if told.command == "combine-submissions":
        return combine(spark, told.template, told.branches, told.out)
    if told.command.startswith("run-"):
        return run_plan(spark, told.folder, told.plan, told.out, told.model, told.cache, "long" if told.command.endswith("long") else "tables")
    if told.command == "hash-report":
        found = hash_report(spark, told.folder)
    else:
        kind, run = (LongConfig, prepare_long) if told.command == "prepare-long" else (TableConfig, prepare_tables)
        config = kind.from_json(told.config) if told.config else kind()
        distinct = _distinct(spark, told.folder)
        unreadable(distinct).write.mode("overwrite").parquet(f"{told.out}-failures")
        found = run(distinct, config).withColumn("config_digest", F.lit(config.digest()))
    found.write.mode("overwrite").parquet(told.out)
    return None


if __name__ == "__main__":
    main()
