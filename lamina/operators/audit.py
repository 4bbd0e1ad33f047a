"""Progress counters, summary rows and their JSON, CSV and HTML sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.text import html_escape


def counters(items: DataFrame, by: list[str], failed: Column, done: Column, reused: Column) -> DataFrame:
    """(by, image_count, succeeded, failed, pending, reused, fresh, status)."""
    ok = done & ~failed
    told = items.groupBy(*by).agg(F.count(F.lit(1)).alias("image_count"), F.count_if(ok).alias("succeeded"), F.count_if(done & failed).alias("failed"), F.count_if(ok & reused).alias("reused"))
    pending = F.greatest(F.lit(0), F.col("image_count") - F.col("succeeded") - F.col("failed"))
    status = F.when(pending > 0, "running").when(F.col("failed") > 0, "finished with errors").otherwise("finished")
    return told.select(*by, "image_count", "succeeded", "failed", pending.cast("long").alias("pending"), "reused", (F.col("succeeded") - F.col("reused")).alias("fresh"), status.alias("status"))


def prepared_unique(processed: Column, failed: Column) -> Column:
    """Distinct images that were prepared: those processed without those that failed."""
    return F.greatest(F.lit(0), processed - failed)


def failed_names(failures: DataFrame) -> DataFrame:
    """Groups and files of failures (file_names: array)."""
    return failures.agg(F.count(F.lit(1)).alias("failure_count"), F.coalesce(F.sum(F.size("file_names")), F.lit(0)).cast("long").alias("failed_image_count"))


def html_rows(summary: DataFrame, columns: list[str], status: str) -> DataFrame:
    """(html): each row escaped, coloured by its status."""
    colour = F.when(F.col(status).contains("error") | (F.col(status) == "failed"), "#fdd").when(F.col(status) == "running", "#ffd").otherwise("#dfd")
    cells = F.concat(*[F.concat(F.lit("<td>"), html_escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in columns])
    return summary.select(*columns, F.concat(F.lit('<tr style="background:'), colour, F.lit('">'), cells, F.lit("</tr>")).alias("html"))


def write(summary: DataFrame, folder: str, columns: list[str], status: str, order: str) -> None:
    """The summary as JSON, CSV and HTML, each committed as a whole by Spark's writers; a summary is one small file."""
    one = summary.select(*columns, status).distinct() if status not in columns else summary.select(*columns)
    ordered = one.orderBy(order).coalesce(1)
    ordered.write.mode("overwrite").json(f"{folder}/summary_json")
    ordered.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(f"{folder}/summary_csv")
    html_rows(ordered, columns, status).select("html").coalesce(1).write.mode("overwrite").text(f"{folder}/summary_html")


def artifact_label(path: Column, labels: dict[str, str]) -> Column:
    """A readable name for an artifact: the label of the first pattern that matches, with its number."""
    number = F.coalesce(F.regexp_extract(path, r"(\d+)\.[^.]+$", 1).try_cast("int"), F.lit(0))
    tried = [F.when(path.rlike(p), F.concat(F.lit(label), F.lit("_"), F.format_string("%03d", number))) for p, label in labels.items()]
    return F.coalesce(*tried, F.regexp_extract(path, r"([^/]+)$", 1))
