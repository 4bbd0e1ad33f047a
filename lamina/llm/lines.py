"""Line dedup: lines that many documents share are dropped.

A first pass fills the two Bloom filters of line digests, a second sends on only digests that the filter of repeats
holds, counted per task; they are counted exactly and those found in ``min_docs`` documents confirmed.  Documents are
not shuffled as long as the confirmed digests fit a bounded broadcast; beyond it the digests are joined to the rows'
lines and each row gets its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch, others

SPACES = b" \t\n\v\f\r"
#: Confirmed digests (16 bytes and an id each) are broadcast up to this number.
BROADCAST_LINES = 1_000_000
#: Digests a task counts at once before it sends them on.
HELD = 300_000


def line_digests(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """A 128-bit digest of each line's key; None where the key is too short to count."""
    import xxhash

    keys = [x.strip(SPACES).lower() for x in lines]
    digest = xxhash.xxh3_128_digest
    if min_chars <= 1:
        return [digest(k) if len(k) >= min_chars else None for k in keys]
    return [digest(k) if len(k) >= min_chars and len(k.decode("utf-8")) >= min_chars else None for k in keys]


def _of(text: str | None, min_chars: int) -> list[bytes | None]:
    return line_digests((text or "").encode("utf-8").split(b"\n"), min_chars)


def _hash(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2]


def drop_repeated_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    into: str = "lines",
    broadcast_lines: int = BROADCAST_LINES,
) -> DataFrame:
    r"""The documents with a struct ``into`` (text, n_lines, n_dropped); rows and other columns stay.

    Texts are split at ``\n``.  A line's key is the line stripped of ASCII white space with A-Z lower-cased; a key of
    ``min_chars`` code points or more that occurs in ``min_docs`` rows or more loses all its lines, or all but the
    first line of the row with the smallest id if ``keep_first``.

    Null and empty texts are one empty line and stay as they are (a null text stays null).  Each row counts as a
    document, repeated rows too.  Null ids come last for ``keep_first``.  Keys count as equal if their 128-bit digests
    are.  A column named ``into`` gives way.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    content = F.coalesce(F.col(text_col), F.lit(""))
    n_lines = docs.agg(F.sum(F.length(content) - F.length(F.replace(content, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = bloom.filter_bits(n_lines)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), content.alias("text"))

    def hashes(batch):
        found: list[bytes] = []
        for text in batch.column(1):
            found += {d for d in _of(text.as_py(), min_chars) if d}
        return _hash(found)

    twice = spark.sparkContext.broadcast(bloom.repeats(texts, hashes, bits))

    def suspects(batches):
        held: dict[bytes, list] = {}
        for batch in batches:
            rows = [(key.as_py(), list({d for d in _of(text.as_py(), min_chars) if d})) for key, text in zip(batch.column(0), batch.column(1), strict=True)]
            flat = [d for _, ds in rows for d in ds]
            passed = iter(bloom.contains(twice.value, _hash(flat), bits))
            for key, ds in rows:
                for d in ds:
                    if next(passed):
                        if d in held:
                            held[d][0] += 1
                            if key is not None and (held[d][1] is None or key < held[d][1]):
                                held[d][1] = key
                        else:
                            held[d] = [1, key]
            if len(held) > HELD:
                yield _counted(held)
                held = {}
        yield _counted(held)

    counted = texts.mapInArrow(suspects, "digest binary, n long, first_id long").groupBy("digest").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"))
    confirmed = scratch.table(counted.where(F.col("n") >= min_docs).select("digest", "first_id"), "confirmed")

    def apply(text: str | None, key: int | None, firsts, digests: list[bytes | None]) -> tuple:
        lines = (text or "").split("\n")
        kept, met = [], set()
        for line, d in zip(lines, digests, strict=True):
            if d is None or d not in firsts:
                kept.append(line)
            elif keep_first and firsts[d] == key and d not in met:
                met.add(d)
                kept.append(line)
        return None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)

    fields = "text string, n_lines long, n_dropped long"
    if confirmed.count() <= broadcast_lines:
        twice.destroy()  # else every worker keeps it
        # 16 bytes a digest and 8 an id: sorted arrays, not a dict in each worker.
        told = confirmed.orderBy("digest").toPandas()
        digests = np.frombuffer(b"".join(map(bytes, told["digest"])), "S16") if len(told) else np.zeros(0, "S16")
        ids = told["first_id"].astype("Int64")
        table = spark.sparkContext.broadcast((digests, ids.fillna(0).to_numpy(np.int64), ids.notna().to_numpy()))

        def firsts_of(own: list[bytes | None]) -> dict[bytes, int | None]:
            asked = list({d for d in own if d})
            keys, numbers, known = table.value
            if not asked or not len(keys):
                return {}
            wanted = np.frombuffer(b"".join(asked), "S16")
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return {asked[i]: int(numbers[at[i]]) if known[at[i]] else None for i in np.flatnonzero(keys[at] == wanted)}

        @F.pandas_udf(fields)
        def cleaned(keys: pd.Series, found: pd.Series) -> pd.DataFrame:
            own = [_of(t, min_chars) for t in found]
            return pd.DataFrame([apply(t, None if pd.isna(k) else int(k), firsts_of(d), d) for k, t, d in zip(keys, found, own, strict=True)], columns=["text", "n_lines", "n_dropped"])

        return docs.select(*others(docs, into), cleaned(F.col(id_col).cast("long"), F.col(text_col)).alias(into))

    def lines_of(batches):
        for batch in batches:
            where, digests = [], []
            for row, text in zip(batch.column(0), batch.column(1), strict=True):
                own = list({d for d in _of(text.as_py(), min_chars) if d})
                own = [d for d, yes in zip(own, bloom.contains(twice.value, _hash(own), bits), strict=True) if yes]
                where += [row.as_py()] * len(own)
                digests += own
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.string()), pa.array(digests, pa.binary())], ["row", "digest"])

    row_key = F.sha2(F.concat_ws("\x00", F.col(id_col).cast("string"), content), 256)
    own = docs.select(row_key.alias("row"), content.alias("text")).mapInArrow(lines_of, "row string, digest binary").join(confirmed, "digest")
    own = own.groupBy("row").agg(F.collect_set(F.struct("digest", "first_id")).alias("own"))  # no more than a row's lines
    packed = docs.select(F.struct(F.lit(0).alias("__one"), *others(docs, into)).alias("kept"), row_key.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    @F.pandas_udf(fields)
    def cleaned_by_row(keys: pd.Series, found: pd.Series, digests: pd.Series, firsts: pd.Series) -> pd.DataFrame:
        rows = []
        for k, t, d, f in zip(keys, found, digests, firsts, strict=True):
            own = {} if d is None else {bytes(a): None if pd.isna(b) else int(b) for a, b in zip(d, f, strict=True)}
            rows.append(apply(t, None if pd.isna(k) else int(k), own, _of(t, min_chars)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    joined = packed.join(own, "row", "left")
    return joined.select("kept.*", cleaned_by_row("id", "text", F.col("own.digest"), F.col("own.first_id")).alias(into)).drop("__one")


def _counted(held: dict[bytes, list]):
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())], ["digest", "n", "first_id"])
