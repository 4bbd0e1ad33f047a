"""Quality rules: base counts of words, lines and repeats, and the fertility of a public vocabulary.

Fertility rules look at how a vocabulary cuts the text: code points per token, the share of byte-fallback tokens and
the entropy of the tokens.  Each has a band per language, or per script where a text's language has none; a text outside
a band is rejected.  Entropy grows with a text's length, so its band is what lies no further than a margin below a curve
over the logarithm of the number of tokens.  ``calibrate`` measures the bands of each language and script on all
documents that are labelled good; ``BANDS`` stand in for scripts that they lack.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch, others

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Ranges of code points by which a text's letters vote for a script.
SCRIPTS = {"latin": r"[A-Za-zªºÀ-ɏḀ-ỿ]", "greek": r"[Ͱ-Ͽἀ-῿]", "cyrillic": r"[Ѐ-ԯ]", "cjk": r"[぀-ヿ㐀-䶿一-鿿가-힯]"}
#: Bands by script: least and most code points per token, most byte-fallback share, and least entropy in bits.  A
#: text of n tokens can't reach more than log2(n) bits: the least is ``entropy`` or ``of_log`` times log2(n), whichever
#: is smaller.
BANDS = {
    "latin": {"chars": (1.2, 8.0), "fallback": 0.25, "entropy": 5.6, "of_log": 0.62},
    "greek": {"chars": (0.4, 6.0), "fallback": 0.6, "entropy": 4.0, "of_log": 0.45},
    "cyrillic": {"chars": (0.8, 6.0), "fallback": 0.4, "entropy": 4.5, "of_log": 0.45},
    "cjk": {"chars": (0.3, 3.0), "fallback": 0.9, "entropy": 4.0, "of_log": 0.45},
    "other": {"chars": (0.2, 8.0), "fallback": 1.0, "entropy": 3.0, "of_log": 0.35},
}
#: Documents labelled good that a language or script needs for its own band.
LEAST_LABELLED = 100
#: Share of the good documents that may lie beyond each edge of a band.
BEYOND = 0.002
#: Bits of a double that one round of a search for order statistics settles, and room for rounding at a margin.
ROUND_BITS, ROUNDING = 12, 1e-9
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, script string, n_tokens long, chars_per_token double, fallback_share double, token_entropy double, kept boolean"

_compiled = {k: re.compile(v) for k, v in SCRIPTS.items()}
_pieces: dict[str, tuple] = {}


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words that lie in an n-word window found twice or more."""
    if len(words) <= n:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    window = ids
    for k in range(1, n):  # windows of k+1 words get one exact code each
        window = window[: len(ids) - k] * len(codes) + ids[k:]
        if k < n - 1 and len(codes) ** (k + 2) >= 1 << 62 or window.max(initial=0) >= (1 << 62) // max(1, len(codes)):
            window = np.unique(window, return_inverse=True)[1]
    _, first, counts = np.unique(window, return_inverse=True, return_counts=True)
    marks = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(counts[first] > 1)
    marks[at] += 1
    np.subtract.at(marks, np.minimum(at + n, len(ids)), 1)
    return int((np.cumsum(marks)[: len(ids)] > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; null counts as empty."""
    text = text or ""
    words = text.encode("utf-8").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def script(text: str) -> str:
    """The script of most of a text's letters; ``other`` without a letter."""
    if text.isascii():  # all its letters are Latin
        return "latin" if _compiled["latin"].search(text) else "other"
    letters = sum(map(str.isalpha, text))
    votes = {k: len(x.findall(text)) for k, x in _compiled.items()}
    votes["other"] = letters - sum(votes.values())
    return max(votes, key=votes.get) if letters else "other"


def fertility(text: str, ids: np.ndarray, is_byte: np.ndarray) -> tuple[int, float, float, float]:
    """Tokens, code points per token, byte-fallback share and token entropy in bits."""
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    share = np.unique(ids, return_counts=True)[1] / n
    return n, len(text) / n, float(is_byte[ids].mean()), float(-(share * np.log2(share)).sum())


def verdict(n: int, chars: float, fallback: float, entropy: float, band: dict) -> bool:
    if not n:
        return True  # no token, no fertility: only the base rules judge
    (low, high), log_n = band["chars"], math.log2(n)
    if "curve" in band:
        least = np.polyval(band["curve"], (log_n - band["centre"]) / band["scale"]) - band["margin"]
    else:
        least = min(band["entropy"], band["of_log"] * log_n)
    return bool(low <= chars <= high and fallback <= band["fallback"] and entropy >= least)


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of doubles; both zeros are one."""
    raw = (np.asarray(x, np.float64) + 0.0).view(np.uint64)
    return np.where(raw >> np.uint64(63), ~raw, raw | np.uint64(1 << 63))


def _double(x: int) -> float:
    return float(np.array([x ^ (1 << 63) if x >> 63 else x ^ ((1 << 64) - 1)], np.uint64).view(np.float64)[0])


def order_statistics(table: DataFrame, values, wanted: list[tuple]) -> list[float]:
    """The exact order statistics ``wanted``, as (what, rank from 0), over the whole table.

    ``values`` gives, for an Arrow batch, the values of each ``what``.  A round counts the values by the next
    ``ROUND_BITS`` bits among those that share the bits found so far, so only counts reach the driver.
    """
    found, ranks, left = [0] * len(wanted), [rank for _, rank in wanted], 64
    while left:
        step = min(ROUND_BITS, left)
        places = {place: i for i, place in enumerate(dict.fromkeys((what, prefix) for (what, _), prefix in zip(wanted, found, strict=True)))}

        def count(batches, places=places, left=left, step=step):
            for batch in batches:
                told = {what: _ordered(x) for what, x in values(batch).items()}
                rows = [np.zeros((3, 0), np.int64)]
                for (what, prefix), i in places.items():
                    x = told[what]
                    if left < 64:
                        x = x[x >> np.uint64(left) == np.uint64(prefix)]
                    cells, n = np.unique(x >> np.uint64(left - step) & np.uint64((1 << step) - 1), return_counts=True)
                    rows.append(np.stack([np.full(len(n), i), cells.astype(np.int64), n]))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.concatenate(rows, 1)], ["place", "cell", "n"])

        counted = table.mapInArrow(count, "place long, cell long, n long").groupBy("place", "cell").agg(F.sum("n").alias("n"))
        cells = counted.toPandas().sort_values(["place", "cell"])  # 2 ** ROUND_BITS rows a place at most
        by_place = {int(i): (x["cell"].to_numpy(), np.cumsum(x["n"].to_numpy())) for i, x in cells.groupby("place")}
        for j, (what, _) in enumerate(wanted):
            cell, upto = by_place[places[what, found[j]]]
            at = int(np.searchsorted(upto, ranks[j], "right"))
            ranks[j] -= int(upto[at - 1]) if at else 0
            found[j] = found[j] << step | int(cell[at])
        left -= step
    return [_double(x) for x in found]


def measured_bands(good: DataFrame, least: int, beyond: float = BEYOND) -> dict:
    """The bands of scripts and languages that ``least`` rows or more have: their quantiles over all rows, and a parabola
    of entropy over the logarithm of the length.

    ``good`` has lang, script, n_tokens, chars_per_token, fallback_share and token_entropy.  Edges of code points per
    token and of fallback lie a tenth of the spread outside the quantiles.  Sums are decimal, so reruns agree.
    """
    log_n, bands = F.log2(F.col("n_tokens").cast("double")), {}
    for column in ("script", "lang"):
        groups = good.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("n_tokens").alias("lengths"), F.min(log_n).alias("low"), F.max(log_n).alias("high"))
        for r in groups.where(F.col("n") >= least).collect():  # a script or language each
            bands[column, r[column]] = {"n": r["n"], "degree": 2 if r["lengths"] > 2 else 0, "centre": (r["low"] + r["high"]) / 2, "scale": (r["high"] - r["low"]) / 2 or 1.0}
    if not bands:
        return {}
    for (column, key), band in bands.items():
        band["t"] = (log_n - band["centre"]) / band["scale"]
        powers = {f"x{i}": band["t"] ** i for i in range(5)} | {f"y{i}": F.col("token_entropy") * band["t"] ** i for i in range(3)}
        sums = good.where(F.col(column) == key).agg(*[F.sum(x.cast("decimal(28,15)")).alias(k) for k, x in powers.items()]).first()
        d = band["degree"]
        matrix = np.array([[float(sums[f"x{i + j}"]) for j in range(d, -1, -1)] for i in range(d, -1, -1)])
        band["curve"] = np.linalg.lstsq(matrix, np.array([float(sums[f"y{i}"]) for i in range(d, -1, -1)]), rcond=None)[0].tolist()
        del band["t"]

    def values(batch) -> dict:
        held = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("script", "lang", "n_tokens", "chars_per_token", "fallback_share", "token_entropy")}
        told = {}
        for (column, key), band in bands.items():
            own = held[column] == key
            x = (np.log2(held["n_tokens"][own].astype(float)) - band["centre"]) / band["scale"]
            told |= {(column, key, "chars"): held["chars_per_token"][own], (column, key, "fallback"): held["fallback_share"][own], (column, key, "residual"): held["token_entropy"][own] - np.polyval(band["curve"], x)}
        return told

    quantiles = [(column, key, name, q) for column, key in bands for name, q in (("chars", beyond), ("chars", 1 - beyond), ("fallback", 1 - beyond), ("residual", beyond))]
    places = [(bands[column, key]["n"] - 1) * q for column, key, _, q in quantiles]
    wanted = [((*quantile[:3],), rank) for quantile, place in zip(quantiles, places, strict=True) for rank in (math.floor(place), math.ceil(place))]
    ends = order_statistics(good, values, wanted)
    edge = {quantile: low + (high - low) * (place % 1) for quantile, place, low, high in zip(quantiles, places, ends[::2], ends[1::2], strict=True)}
    out = {}
    for (column, key), band in bands.items():  # a language's band comes after a script's of the same name
        low, high = edge[column, key, "chars", beyond], edge[column, key, "chars", 1 - beyond]
        spread = 0.1 * (high - low)
        margin = max(0.0, -edge[column, key, "residual", beyond]) + ROUNDING
        out[key] = {"chars": (low - spread, high + spread), "fallback": 1.1 * edge[column, key, "fallback", 1 - beyond] + 0.01, "margin": margin, **{k: band[k] for k in ("curve", "centre", "scale")}}
    return out


def _vocabulary(path: str):
    if path not in _pieces:
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_file=path)
        _pieces[path] = piece, np.array([piece.is_byte(i) for i in range(piece.vocab_size())])
    return _pieces[path]


def band_of(bands: dict, lang: str | None, kind: str) -> dict:
    return bands.get(lang) or bands.get(kind) or bands["other"]


def assess(text: str | None, lang: str | None, piece, is_byte: np.ndarray, bands: dict) -> tuple:
    counts = base_counts(text)
    failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
    text = text or ""
    kind = script(text)
    told = fertility(text, np.asarray(piece.encode(text), np.int64), is_byte)
    return *counts, failed, kind, *told, not failed and verdict(*told, band_of(bands, lang, kind))


#: What bands are measured from, in the order of ``FIELDS``.
NUMBER_TYPES = (pa.bool_(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
NUMBERS = ("base_failed", "script", "n_tokens", "chars_per_token", "fallback_share", "token_entropy")


def _good_ids(labels: DataFrame, id_col: str) -> DataFrame:
    return labels.where((F.col("quality") == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id")).distinct()


def _good(numbers: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of good ids that pass the base rules; labels grow with the documents, so they are not broadcast."""
    return numbers.join(ids.hint("merge"), F.col(f"`{id_col}`") == F.col("__id"), "left_semi").where("NOT base_failed AND n_tokens > 0")


def calibrate(docs: DataFrame, labels: DataFrame, vocabulary: str, least: int = LEAST_LABELLED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Bands by language and by script of all documents that ``labels`` (id, quality) calls good.

    Those that fail the base rules are left out; rows that repeat an id count each.  A language or script with fewer
    than ``least`` documents gets no band.  Null ids and labels are none; an empty table gives no bands.  A Bloom filter
    of the good ids leaves their texts and few others, so texts are not shuffled; a join then tells them exactly.
    """
    spark, ids = docs.sparkSession, _good_ids(labels, id_col)
    scratch, key = Scratch(spark, "quality"), lambda c: F.xxhash64(F.col(c).cast("string"))
    bits = bloom.filter_bits(ids.count())
    shared = spark.sparkContext.broadcast(bloom.members(ids.select(key("__id")), bits))

    def judged(batches):  # one Python worker a task filters and judges
        piece, is_byte = _vocabulary(vocabulary)
        for batch in batches:
            keys = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            some = batch.filter(pa.array(bloom.contains(shared.value, keys, bits)))
            told = [dict(zip(names, assess(t.as_py(), None, piece, is_byte, BANDS), strict=True)) for t in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(2), *(pa.array([x[c] for x in told], kind) for c, kind in zip(NUMBERS, NUMBER_TYPES, strict=True))], ["id", "lang", *NUMBERS])

    names, source = [x.split()[0] for x in FIELDS.split(", ")], F.col(id_col)
    texts = docs.select(source.alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), key(id_col).alias("key"))
    fields = [x for x in FIELDS.split(", ") if x.split()[0] in NUMBERS]
    numbers = scratch.table(texts.mapInArrow(judged, f"id {texts.schema['id'].dataType.simpleString()}, lang string, {', '.join(fields)}"), "numbers")
    good = scratch.table(_good(numbers, ids, "id"), "good")
    bands = measured_bands(good, least)
    shared.destroy()
    for done in ("numbers", "good"):
        scratch.drop(done)
    return bands


def judge_by_labels(docs: DataFrame, labels: DataFrame, vocabulary: str, least: int = LEAST_LABELLED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", into: str = "quality") -> DataFrame:
    """``judge`` by the bands that ``calibrate`` measures, with each text cut into tokens once, and the documents without their text.

    The other columns are written with the numbers; bands and verdicts then come from those.
    """
    scratch, told = Scratch(docs.sparkSession, "quality"), judge(docs, vocabulary, None, text_col, lang_col, into)
    told = scratch.table(told.drop(text_col), "told")
    numbers = told.select(F.col(f"`{id_col}`"), F.col(lang_col).cast("string").alias("lang"), *[F.col(f"{into}.{c}").alias(c) for c in NUMBERS])
    good = scratch.table(_good(numbers, _good_ids(labels, id_col), id_col), "good")
    rules = BANDS | measured_bands(good, least)
    scratch.drop("good")

    @F.pandas_udf("boolean")
    def kept(failed: pd.Series, script: pd.Series, n: pd.Series, chars: pd.Series, fallback: pd.Series, entropy: pd.Series, langs: pd.Series) -> pd.Series:
        rows = zip(failed, script, n, chars, fallback, entropy, langs, strict=True)
        return pd.Series([not f and verdict(*x, band_of(rules, lang, kind)) for f, kind, *x, lang in rows], dtype=bool)

    judged = kept(*[F.col(f"{into}.{c}") for c in NUMBERS], F.col(lang_col).cast("string"))
    return told.select(*others(told, into), F.col(into).withField("kept", judged).alias(into))


def judge(docs: DataFrame, vocabulary: str, bands: dict | None = None, text_col: str = "text", lang_col: str | None = None, into: str = "quality") -> DataFrame:
    """The documents with a struct ``into`` of all counts and the verdict; rows and other columns stay.

    ``vocabulary`` is a sentencepiece model with byte fallback.  ``bands`` is laid over ``BANDS``; keys are scripts, or
    values of ``lang_col``, which come first; a null or unknown language is judged by script.  Null text counts as
    empty: no words, so it is rejected.  A text is judged whole, however long, and by itself, so repeated rows get the
    same verdict; there are no ties.  A column named ``into`` gives way.  Empty tables give no rows; nothing is shuffled.
    """
    rules = BANDS | (bands or {})

    @F.pandas_udf(FIELDS)
    def assessed(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        piece, is_byte = _vocabulary(vocabulary)
        rows = [assess(t, x, piece, is_byte, rules) for t, x in zip(texts, langs, strict=True)]
        return pd.DataFrame(rows, columns=[x.split()[0] for x in FIELDS.split(", ")])

    return docs.select(*others(docs, into), assessed(F.col(text_col), F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")).alias(into))
