"""Incremental ingest of a manifest folder: what has arrived is upserted and what is known is skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lamina.operators.cache import latest


def ingest(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, keys: list[str], order: list[str]) -> DataFrame:
    """Takes all new files of ``source`` into ``target``, one folder a batch, and returns the latest row of each key.

    A batch that is repeated after a failure overwrites its own folder, so it counts once.
    """

    def store(batch: DataFrame, number: int) -> None:
        latest(batch, keys, order).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return latest(spark.read.parquet(target).drop("batch"), keys, order)


def windowed_counts(events: DataFrame, time: str = "ts", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts by hour and type of a batch or a stream; times without a zone are read in the session's."""
    timed = events.withColumn("_t", F.col(time).cast("timestamp"))
    timed = timed.withWatermark("_t", late) if events.isStreaming else timed
    return timed.groupBy(F.window("_t", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
