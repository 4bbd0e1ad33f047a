"""The two-column result file: strict reading and single-file writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ["file_name", "ground_truth"]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, ground_truth) of a CSV with quoted line breaks; an empty result is "", never null.

    The header must be exactly the two columns; empty and repeated names are errors.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": -1, "encoding": "UTF-8", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    found = spark.read.options(**options).csv(path)
    if [c.lstrip("﻿") for c in found.columns] != COLUMNS:
        raise ValueError(f"header {found.columns} instead of {COLUMNS}")
    rows = found.toDF(*COLUMNS).withColumn("ground_truth", F.coalesce("ground_truth", F.lit("")))
    bad = rows.groupBy("file_name").count().where("file_name IS NULL OR trim(file_name) = '' OR count > 1").limit(3).collect()
    if bad:
        raise ValueError(f"empty or repeated file names: {[r.file_name for r in bad]}")
    return rows


def write(results: DataFrame, path: str, template: DataFrame | None = None) -> None:
    """One CSV file in template order, or by name; raises where names are missing, extra or repeated."""
    from lamina.operators.submit import combine

    ordered = results.select(*COLUMNS).orderBy("file_name") if template is None else combine(template, [results.select(*COLUMNS)]).select(*COLUMNS)
    ordered.coalesce(1).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path)
