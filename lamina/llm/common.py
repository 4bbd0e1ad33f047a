"""Shared helpers: scratch tables in the cluster's shared folder, word rules, text digests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of code points other than the six ASCII white-space characters.  ``bytes.split()`` splits at
#: exactly these, so UTF-8 bytes split that way give the same words.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver share (``spark.checkpoint.dir``).

    Where a session on one machine names none, as in tests, a folder under the system's temporary directory is set for
    it; on a cluster, whose executors would not see that folder, its absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lamina-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Rows of an Arrow batch: whole texts can be long, and a batch is held by Spark and by Python at once.
BATCH_ROWS = "1000"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, unless the session asks for some other number than the default."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, BATCH_ROWS)


class Scratch:
    """Tables written to the shared folder; they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_dir(spark)}/lamina-{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, **options) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def others(docs: DataFrame, *taken: str) -> list[Column]:
    """The columns of ``docs`` but for those that new columns of the names ``taken`` replace (letter case apart)."""
    gone = {name.lower() for name in taken}
    return [F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone]


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` has it."""
    held = {c.lower() for c in docs.columns}
    while name.lower() in held:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of words, on the JVM; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8").split() if text else []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels beside the documents; none where the folder has no such table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/labels.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.parquet(f"{sf_dir}/labels.parquet")
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
