"""A corpus pipeline over ``documents``: quality rules, line dedup, near-dedup, mixing and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as
the next stage's documents.  All stages but the last keep the documents' columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import Scratch, documents, free_name, labels, small_batches
from lamina.llm.lines import drop_repeated_lines
from lamina.llm.mixing import mixed
from lamina.llm.packing import pack
from lamina.llm.quality import calibrate, judge
from lamina.llm.queries import vocabulary
from lamina.llm.simhash import one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go; bands are measured on all of ``labels``
    (where there is no such table, the fixed bands of each script hold).

    Null and empty texts are rejected; a null or unknown language is judged by script.  Texts are judged whole and each
    by itself, so repeated rows stay or go together.  An empty table gives no rows.
    """
    small_batches(spark)
    path, told = vocabulary("piece_bpe_32k.model"), free_name(docs, "told")
    bands = calibrate(docs, labels(spark, sf_dir), path)
    return judge(docs, path, bands, lang_col="lang", into=told).where(f"{told}.kept").drop(told)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go from all but the first (the smallest id, null last).

    ``n_chars`` follows the text.  Null texts stay null; empty lines and white ones stay; each repeated row counts as a
    document.  Documents stay even where no line of theirs does.  An empty table gives no rows.
    """
    told = free_name(docs, "told")
    changed = {"text": F.col(f"{told}.text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length(changed["text"]).cast(docs.schema["n_chars"].dataType)
    cleaned = drop_repeated_lines(docs, keep_first=True, into=told)
    return cleaned.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; links are pairs of 5-word Jaccard similarity 0.8 or more.

    SimHash fingerprints find the closest copies, prefixes of the shingle sets the others; every link is confirmed by
    the sets themselves.  The smallest id stays, null ids last, by text where ids repeat; texts without a word, null
    ones too, are copies of each other.  An empty table gives no rows.
    """
    return one_of_each(docs, shingle=5, similarity=0.8)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as their source's target asks for.

    Null sources are a source, last in order; null ids draw by their text; null and empty texts have size 0.  Rows that
    repeat in id and text are taken together, and so are ties of a rank.  An empty table gives no rows.
    """
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's tokens in sequences of 2048.

    Null and empty texts are a separator alone; longer documents than a sequence are cut; repeated rows and null ids
    are packed each.  An empty table gives no rows.
    """
    return pack(docs, vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the tokenizers or XXH64; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the written result of the one before."""
    scratch, docs = Scratch(spark, "pipeline"), documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = scratch.table(docs, f"stage-{k}")
            if k:
                scratch.drop(f"stage-{k - 1}")
    return docs
