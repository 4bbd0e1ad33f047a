"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counting and scoring each read the texts once and shuffle none of them.  Each task adds its counts up per language;
what it sends on are blocks of counts, merged one after another, so memory is bounded by the matrix.  The matrix of
log probabilities (features x languages, single precision) is broadcast.  Its size depends on the number of languages
alone, and ``max_matrix_mb`` is the bound that it is checked against before anything is counted.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import others

#: Fixed odd multipliers that mix the code points of an n-gram.
MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))
UNDETERMINED = "und"
BLOCK = 4096
#: Numbers (buckets x languages) that scoring holds at once.
ROWS_AT_ONCE = 2_000_000


def features(text: str, bits: int) -> np.ndarray:
    """Buckets of all 1-, 2- and 3-grams of the lower-cased code points; line breaks count as spaces."""
    c = np.frombuffer(text.lower().replace("\n", " ").encode("utf-32-le", "replace"), np.uint32)
    one = c * MIX[0]
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * MIX[1] + c[1:] * MIX[2]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * MIX[0] + c[2:] * MIX[1]
    return np.concatenate([one, two, three]) >> np.uint32(32 - bits)


def _counting(bits: int):
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        n_docs: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                n_docs[lang] = n_docs.get(lang, 0) + 1
                if lang not in sums:
                    sums[lang] = np.zeros(1 << bits, np.int64)
                sums[lang] += np.bincount(features(text, bits), minlength=1 << bits)
        rows = [(lang, k, n_docs[lang] * (k == 0), zlib.compress(part.tobytes(), 1)) for lang, total in sums.items() for k, part in enumerate(np.split(total, max(1, (1 << bits) // BLOCK))) if k == 0 or part.any()]
        yield _rows(rows)

    return run


def _rows(rows):
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["lang", "block", "docs", "counts"])


def _merging(batches):
    sums: dict[tuple, list] = {}
    for batch in batches:
        for lang, block, docs, counts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            new = np.frombuffer(zlib.decompress(counts), np.int64)
            if (key := (lang, block)) in sums:
                sums[key][0] += docs
                sums[key][1] = sums[key][1] + new
            else:
                sums[key] = [docs, new]
    yield _rows([(*key, docs, zlib.compress(total.tobytes(), 1)) for key, (docs, total) in sums.items()])


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", bits: int = 16, max_matrix_mb: int = 512) -> dict:
    """The model of all rows with a language and a text: ``langs``, ``bits`` and the matrix of log probabilities.

    Every row counts, repeated ones too, with its whole text; null languages and texts don't, and an empty text only
    counts for its language's share.  An empty table gives a model without a language.  There are ``2 ** bits`` features
    whatever the number of languages; a matrix of more than ``max_matrix_mb`` (2048 languages at 16 bits) is an error.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    n_langs = rows.select("lang").distinct().count()
    if n_langs * (4 << bits) > max_matrix_mb << 20:
        raise ValueError(f"{n_langs} languages don't fit a matrix of {max_matrix_mb} MB; raise max_matrix_mb")
    merged = rows.mapInArrow(_counting(bits), "lang string, block int, docs long, counts binary").repartition("lang", "block").mapInArrow(_merging, "lang string, block int, docs long, counts binary")
    counts: dict[str, np.ndarray] = {}
    n_docs: dict[str, int] = {}
    for row in merged.toLocalIterator():
        counts.setdefault(row.lang, np.zeros(1 << bits))[row.block * BLOCK : row.block * BLOCK + BLOCK] += np.frombuffer(zlib.decompress(row.counts), np.int64)
        n_docs[row.lang] = n_docs.get(row.lang, 0) + row.docs
    langs = sorted(counts)
    smooth = np.array([counts[x] for x in langs]).reshape(len(langs), 1 << bits) + 0.5
    log_p = np.log(smooth / smooth.sum(1, keepdims=True)).T.astype(np.float32)
    prior = np.log(np.array([n_docs[x] for x in langs], float) / max(1, sum(n_docs.values())))
    return {"langs": langs, "bits": bits, "log_p": log_p, "prior": prior}


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def score(texts: list[str | None], model: dict) -> tuple[list[str], list[float]]:
    """Best language and its posterior for each text, for a whole batch at once."""
    langs, best, sure = model["langs"], [UNDETERMINED] * len(texts), [0.0] * len(texts)
    at = [i for i, t in enumerate(texts) if langs and has_letter(t)]
    most = max(1, ROWS_AT_ONCE // max(1, len(langs)))
    lo = 0
    while lo < len(at):
        found, size = [], 0
        while lo + len(found) < len(at) and len(found) < 64 and (not found or size < most):
            found.append(features(texts[at[lo + len(found)]], model["bits"]))
            size += len(found[-1])
        some = at[lo : lo + len(found)]
        lo += len(found)
        # Rows of the batch as sparse counts: repeated buckets are met once.
        keys, counts = np.unique(np.concatenate([f.astype(np.int64) + (k << 32) for k, f in enumerate(found)]), return_counts=True)
        total, row = np.tile(model["prior"], (len(some), 1)), keys >> 32
        for i in range(0, len(keys), most):  # a long text's buckets in parts, so that memory stays bounded
            part = slice(i, i + most)
            starts = np.flatnonzero(np.diff(row[part], prepend=-1))
            total[row[part][starts]] += np.add.reduceat(model["log_p"][keys[part] & 0xFFFFFFFF] * counts[part, None].astype(np.float64), starts, axis=0)
        top = total.argmax(1)
        for i, k, scores in zip(some, top, total, strict=True):
            best[i], sure[i] = langs[k], float(1 / np.exp(np.minimum(scores - scores[k], 0)).sum())
    return best, sure


def predict(docs: DataFrame, model: dict, text_col: str = "text", into: str = "language") -> DataFrame:
    """The documents with a struct ``into`` (lang_pred, score).

    ``und`` with score 0 where the text is null, has no letter, or the model has learned no language; ties go to the
    first language in code-point order.  Texts are scored whole, each by itself, so repeated rows get one answer; null
    ids play no part.  Rows and all other columns stay as they are, but for one named ``into``, which gives way.  An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def scored(texts: pd.Series) -> pd.DataFrame:
        best, sure = score([None if t is None else t for t in texts], shared.value)
        return pd.DataFrame({"lang_pred": best, "score": sure})

    return docs.select(*others(docs, into), scored(F.col(text_col)).alias(into))


def held_out(id_col: Column, fold: int = 2, of: int = 4) -> Column:
    """Whether a document is kept from training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(of)) == fold, F.lit(False))
