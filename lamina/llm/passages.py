"""Substring dedup: words of passages that recur anywhere in the corpus are removed.

A passage is a window of ``n`` words.  Each window is told by its anchor, the phrase of ``k`` words in it with the
smallest hash (the leftmost of equals): equal windows have equal anchors, and neighbouring windows mostly share one.

1.  Anchors of all documents are counted exactly, by hash; a Bloom filter of those that recur, and of no others, is
    sent to all tasks.
2.  Recurring passages are confirmed: windows of such anchors are counted exactly by anchor and 64-bit digest.
3.  Anchors and their confirmed windows are dealt to shards by hash; frequent anchors are salted, with their confirmed
    windows copied to each salt.  The stretch of each document around such an anchor goes to the anchor's shard.
4.  A shard compiles Aho-Corasick automata of its recurring phrases, chunk by chunk, and streams the stretches through
    them; around each hit it looks up the windows among the confirmed ones and gives the words they cover.
5.  Each document gets the covered words of all its stretches and drops them.

Eight bytes an anchor are shuffled; all other work follows the recurring part of the corpus.  The filter is bounded, and
where more anchors recur than it holds more windows are counted, none is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch, others

#: Fixed odd multipliers of the rolling hash and its last mixing.
BASE, STIR = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
#: Stretches that an automaton is compiled for at once.
CHUNK = 8192
#: Anchors in fewer stretches aren't salted.
FREQUENT = 1000
RUNS = -1  # stands for a digest in rows that count an anchor's stretches


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """A mixed 64-bit hash of each run of n entries, by doubling."""
    size, out, done, now, length = len(h), None, 0, h, 1
    if size < n:
        return h[:0]
    left = n
    with np.errstate(over="ignore"):
        while left:
            power = np.uint64(pow(BASE, length, 1 << 64))
            if left & 1:
                if out is None:
                    out, done = now, length
                else:
                    m = size - done - length + 1
                    out = out[:m] * power + now[done : done + m]
                    done += length
            left >>= 1
            if left:
                m = size - 2 * length + 1
                now = now[:m] * power + now[length : length + m]
                length *= 2
        out = (out ^ (out >> np.uint64(32))) * STIR
        return out ^ (out >> np.uint64(29))


def leftmost_least(g: np.ndarray, w: int) -> np.ndarray:
    """For each window of w entries the index of its smallest, the first of equals."""
    value, at, span = g, np.arange(len(g)), 1

    def closer(shift: int):
        m = len(value) - shift
        later = value[shift:] < value[:m]
        return np.where(later, value[shift:], value[:m]), np.where(later, at[shift:], at[:m])

    while 2 * span <= w:
        value, at = closer(span)
        span *= 2
    if span < w:
        value, at = closer(w - span)
    return at


def anchors(h: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: (anchor hash, its word index, first window, window after the last)."""
    if len(h) < n:
        none = np.zeros(0, np.int64)
        return h[:0], none, none, none
    g = rolling(h, k)
    at = leftmost_least(g, n - k + 1)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    return g[at[first]], at[first], first, np.append(first[1:], len(at))


def _phrase(n: int) -> int:
    return max(1, min(10, n // 3))


def _pair(anchor: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """One 64-bit key of an anchor and a window's digest."""
    with np.errstate(over="ignore"):
        return (anchor.view(np.uint64) * np.uint64(BASE)) ^ (digest.view(np.uint64) * STIR)


def locate(anchors_: np.ndarray, confirmed: tuple[np.ndarray, np.ndarray], at: np.ndarray, texts: list[str], n: int, k: int):
    """(stretch, since, upto): words covered by confirmed windows in stretches of text, by their number.

    Equal stretches are searched once.  One automaton holds the phrases of all anchors; the texts, joined, run through
    it, and the windows around each hit are looked up among the confirmed ones of the hit's anchor.
    """
    import ahocorasick

    number: dict[str, int] = {}
    own = np.fromiter((number.setdefault(t, len(number)) for t in texts), np.int64, len(texts))
    distinct = list(number)
    words = " ".join(distinct).split(" ")
    sizes = np.fromiter((t.count(" ") + 1 for t in distinct), np.int64, len(distinct))
    after = np.cumsum(sizes)
    first = after - sizes
    of = np.repeat(np.arange(len(distinct)), sizes)
    automaton = ahocorasick.Automaton()
    anchor_list, where = np.unique(anchors_, return_index=True)
    for a, i in zip(anchor_list.tolist(), where.tolist(), strict=True):
        p = first[own[i]] + at[i]
        phrase = f" {' '.join(words[p : p + k])} "
        automaton.add_word(phrase, (a, len(phrase)))
    automaton.make_automaton()
    # Each word is preceded by a space; a text ends with a space and a line break.
    starts = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - np.fromiter(map(len, words), np.int64, len(words)) + 2 * of
    hits = [(end - length + 2, a) for end, (a, length) in automaton.iter("\n".join(f" {t} " for t in distinct))]
    if not hits:
        none = np.zeros(0, np.int64)
        return none, none, none
    position, hit = np.array([h[0] for h in hits], np.int64), np.array([h[1] for h in hits], np.int64)
    p = np.searchsorted(starts, position)
    low = np.maximum(p + k - n, first[of[p]])
    count = np.maximum(0, np.minimum(p, after[of[p]] - n) - low + 1)
    window = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    digests = rolling(word_hashes([w.encode("utf-8") for w in words]), n).view(np.int64)
    known = np.isin(_pair(np.repeat(hit, count), digests[window]), _pair(*confirmed))
    window = np.unique(window[known])
    new = np.ones(len(window), bool)
    new[1:] = (window[1:] > window[:-1] + n) | (of[window[1:]] != of[window[:-1]])
    since = window[new]
    upto = window[np.append(np.flatnonzero(new)[1:], len(window)) - 1] + n if len(window) else since
    text = of[since]
    # Back to every stretch of that text.
    spans = np.bincount(text, minlength=len(distinct))
    begin = np.cumsum(spans) - spans
    copies = spans[own]
    index = np.repeat(begin[own] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
    return np.repeat(np.arange(len(own)), copies), since[index] - first[text[index]], upto[index] - first[text[index]]


def remove_repeated_passages(docs: DataFrame, n: int = 35, id_col: str = "doc_id", text_col: str = "text", into: str = "passages", frequent: int = FREQUENT) -> DataFrame:
    """The documents with a struct ``into`` (text, n_words, n_removed); rows and other columns stay.

    ``text`` holds the words that stay, one space between them.  A word goes if it lies in a window of ``n`` words
    that also starts anywhere else, in the same document or another (a repeated row is another); windows are judged on
    the input.  Null text has no word and gives an empty text, as a text of white space does.  Documents of fewer than
    ``n`` words keep all.  Null ids are matched as a value.  An empty table gives no rows.  Windows count as equal if
    their anchors' and their own 64-bit hashes are.  A column named ``into`` gives way.
    """
    spark = docs.sparkSession
    scratch, k = Scratch(spark, "passages"), _phrase(n)
    content = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lit(9), content).alias("text_hash"), content.alias("text"))

    def anchors_of(batches):
        for batch in batches:
            met = np.concatenate([np.zeros(0, np.uint64), *(anchors(word_hashes(t.as_py().encode("utf-8").split()), n, k)[0] for t in batch.column(0))])
            h, times = np.unique(met, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h, h[times > 1]]).view(np.int64))], ["anchor"])  # two tell as much as more

    met = keyed.select("text").mapInArrow(anchors_of, "anchor long").repartition("anchor").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    recurring = scratch.table(met.where("n > 1").select("anchor"), "recurring")
    bits = bloom.filter_bits(recurring.count())
    twice = spark.sparkContext.broadcast(bloom.members(recurring, bits))
    scratch.drop("recurring")

    def suspected(text: str):
        words = text.encode("utf-8").split()
        h = word_hashes(words)
        a, at, first, after = anchors(h, n, k)
        keep = bloom.contains(twice.value, a, bits)
        return words, h, a[keep], at[keep], first[keep], after[keep]

    def windows(batches):
        for batch in batches:
            who, digest = [], []
            for text in batch.column(2):
                _, h, a, _, first, after = suspected(text.as_py())
                if len(a):
                    d, lengths = rolling(h, n), after - first
                    index = np.repeat(first - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
                    who += [np.repeat(a, lengths), a]
                    digest += [d[index].view(np.int64), np.full(len(a), RUNS)]
            none = np.zeros(0, np.int64)
            who, digest = (np.concatenate([none, *(x.view(np.int64) for x in xs)]) for xs in (who, digest))
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(digest)], ["anchor", "digest"])

    counted = keyed.mapInArrow(windows, "anchor long, digest long").groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n"))
    confirmed = scratch.table(counted.where("n > 1"), "confirmed")
    runs = confirmed.where(F.col("digest") == RUNS)
    # Each frequent anchor has a 20,000th of all stretches at least, so there are few.
    often = max(frequent, (runs.agg(F.sum("n")).first()[0] or 0) // 20_000)
    salts = spark.sparkContext.broadcast({r.anchor: -(-r.n // often) for r in runs.where(F.col("n") > often).collect()})

    def stretches(batches):
        from pyspark import TaskContext

        table, own = salts.value, TaskContext.get().partitionId() * 7919
        for batch in batches:
            rows, numbers, texts = [], [np.zeros((4, 0), np.int64)], []
            for row, (text_hash, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2), strict=True)):
                words, _, a, at, first, after = suspected(text.as_py())
                if len(a):
                    a = a.view(np.int64)
                    salt = [(own + row) % table[x] if x in table else 0 for x in a.tolist()] if table else np.zeros(len(a), np.int64)  # copies go to different salts
                    numbers.append(np.stack([a, np.asarray(salt, np.int64), first, at - first]))
                    rows.append(np.full(len(a), row))
                    texts += [b" ".join(words[i:j]) for i, j in zip(first.tolist(), (after + n - 1).tolist(), strict=True)]
            anchor, salt, start, at = np.concatenate(numbers, 1)
            rows = pa.array(np.concatenate([np.zeros(0, np.int64), *rows]))
            yield _batch(anchor, salt, 1, np.zeros(len(anchor), np.int64), batch.column(0).take(rows), batch.column(1).take(rows), start, at, pa.array(texts, pa.binary()).cast(pa.string()))

    def copies(batches):
        table = salts.value
        for batch in batches:
            anchor, digest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            times = np.fromiter((table.get(a, 1) for a in anchor.tolist()), np.int64, len(anchor)) if table else np.ones(len(anchor), np.int64)
            salt = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            none = np.zeros(len(salt), np.int64)
            yield _batch(np.repeat(anchor, times), salt, 0, np.repeat(digest, times), pa.nulls(len(salt), pa.int64()), pa.array(none), none, none, pa.nulls(len(salt), pa.string()))

    def find(batches):
        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, kind, digest = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            confirmed = tuple(np.concatenate([h, x[kind == 0]]) for h, x in zip(held, (anchor, digest), strict=True))
            rows = np.flatnonzero((kind == 1) & np.isin(anchor, confirmed[0]))
            for lo in range(0, len(rows), CHUNK):
                some = pa.array(rows[lo : lo + CHUNK])
                key, text_hash, start, at, text = (batch.column(i).take(some) for i in (4, 5, 6, 7, 8))
                stretch, since, upto = locate(anchor[rows[lo : lo + CHUNK]], confirmed, at.to_numpy(), text.to_pylist(), n, k)
                base = start.to_numpy()[stretch]
                which = pa.array(stretch)
                yield pa.RecordBatch.from_arrays([key.take(which), text_hash.take(which), pa.array(base + since), pa.array(base + upto)], ["id", "text_hash", "since", "upto"])
            # The last anchor may go on in the next batch.
            held = tuple(x[confirmed[0] == anchor[-1]] for x in confirmed)

    schema = "anchor long, salt long, kind int, digest long, id long, text_hash long, start long, at long, text string"
    dealt = confirmed.where(F.col("digest") != RUNS).select("anchor", "digest").mapInArrow(copies, schema).unionByName(keyed.mapInArrow(stretches, schema))
    spans = dealt.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "kind").mapInArrow(find, "id long, text_hash long, since long, upto long")
    # Within one text; rows that repeat in id and text tell the same spans.
    own = spans.groupBy("id", "text_hash").agg(F.collect_set(F.struct("since", "upto")).alias("spans"))

    @F.pandas_udf("text string, n_words long, n_removed long")
    def cut(texts: pd.Series, since: pd.Series, upto: pd.Series) -> pd.DataFrame:
        rows = []
        for text, a, b in zip(texts, since, upto, strict=True):
            words = text.encode("utf-8").split() if text else []
            kept = words
            if a is not None and len(a):
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, np.asarray(a, np.int64), 1)
                np.add.at(gone, np.asarray(b, np.int64), -1)
                kept = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
            rows.append((b" ".join(kept).decode("utf-8"), len(words), len(words) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_words", "n_removed"])

    packed = docs.select(F.struct(F.lit(0).alias("__one"), *others(docs, into)).alias("kept"), F.col(id_col).cast("long").alias("own_id"), F.xxhash64(F.lit(9), content).alias("own_hash"), F.col(text_col).alias("text"))
    joined = packed.join(own, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("text_hash")), "left")
    return joined.select("kept.*", cut("text", F.col("spans.since"), F.col("spans.upto")).alias(into)).drop("__one")


def _batch(anchor, salt, kind: int, digest, key, text_hash, start, at, text):
    columns = [pa.array(anchor), pa.array(salt), pa.array(np.full(len(anchor), kind, np.int32)), pa.array(digest), key, text_hash, pa.array(start), pa.array(at), text]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "kind", "digest", "id", "text_hash", "start", "at", "text"])
