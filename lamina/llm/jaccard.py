"""Near-dedup by exact shingle similarity: rarest shingles first, candidate components, exact links.

A text is the set of its word shingles' hashes.  In one order of all hashes, two sets of Jaccard similarity s or more
share a hash among the first n - ceil(s n) + 1 of each, so only those prefixes are matched and no pair is lost.  The
order puts hashes that no other set holds first (a filter of those that recur, from exact counts, tells them): they
match nothing and are not sent on, and a text of which more than a share of 1 - s is its own sends nothing.  The rest
come by a bounded sketch of the counts, rarest first, so that passages which many unlike texts share seldom lie in a
prefix.  Any fixed order gives the same links; the sketch only makes for fewer candidates.

Fingerprints of the sets that send something go through SimHash's vantage-point tree, which finds the closest copies;
shared prefix hashes find the others.  Components over both hold every similar pair.  The sets of a component meet in
tasks of at most two blocks of ``BLOCK_SETS``, which compare them exactly and send on spanning links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch, word_count
from .components import components
from .passages import rolling, word_hashes
from .simhash import fingerprint_links, fold_bits

#: Bits of the filter a shingle; only shingles that recur are put into it.
PER_HASH = 4
#: Sets of a component that make a block; a task compares two blocks at most.
BLOCK_SETS = 3_000
#: Sets remembered in a task; one met again after that only costs a repeated row.
REMEMBERED = 200_000


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``n`` words, A-Z lower-cased; all words of a shorter text."""
    words = text.encode("utf-8").lower().split() if text else []
    return np.unique(rolling(word_hashes(words), min(n, len(words)))) if words else np.zeros(0, np.uint64)


def prefix_length(n: int, similarity: float) -> int:
    return n - math.ceil(similarity * n - 1e-9) + 1 if n else 0


def exact_links(sets: list[np.ndarray], sizes: np.ndarray, similarity: float) -> np.ndarray:
    """The component of each set over all pairs of at least ``similarity``, as the least index of its sets.

    ``sets`` may lack hashes that no other set holds; ``sizes`` count them.  A pivot is compared with the sets that share
    a hash with it, through inverted lists.  Jaccard distance obeys the triangle inequality, so a set of the pivot's
    component that lies further than 1 - ``similarity`` from all sets outside needs no comparison of its own.
    """
    m = len(sets)
    lengths = np.fromiter(map(len, sets), np.int64, m)
    flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = np.argsort(flat, kind="stable")
    rows = np.repeat(np.arange(m, dtype=np.int32), lengths)[order]
    ranked = flat[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    code = np.empty(len(flat), np.int32)
    code[order] = np.cumsum(new) - 1
    lists = np.append(np.flatnonzero(new), len(ranked))
    del flat, ranked, order, new
    starts = np.concatenate([[0], np.cumsum(lengths)])
    label, done = np.arange(m), np.zeros(m, bool)
    for p in range(m):
        if done[p]:
            continue
        own = code[starts[p] : starts[p + 1]]
        n = lists[own + 1] - lists[own]
        at = np.repeat(lists[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        common = np.bincount(rows[at], minlength=m)
        common[p] = sizes[p]
        either = sizes + sizes[p] - common
        alike = common + 1e-9 >= similarity * either
        joined = np.unique(label[alike | (np.arange(m) == p)])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
        inside, apart = label == label[p], 1 - common / np.maximum(either, 1)
        least = apart[~inside].min(initial=np.inf)
        done |= inside & (apart + (1 - similarity) + 1e-9 < least)
        done[p] = True
    return label


def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK_SETS) -> DataFrame:
    """(id, text_hash, class_fp) for every row; ``class_fp`` is one for rows that links of ``similarity`` or more join.

    Words are as for SimHash, shingles are ``shingle`` words (all words of a shorter text).  Texts without a word, null
    ones too, are alike.  Sets count as equal if a 64-bit hash of theirs is; repeated rows and null ids each give their
    row.  Long texts are whole sets.  An empty table gives none.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    texts = docs.select(F.col(text_col).alias("text"))
    n_words = docs.agg(F.sum(word_count(F.col(text_col)))).first()[0] or 0
    recurring = bloom.Recurring(n_words, PER_HASH)
    bitmap, sketch = recurring.count(texts, lambda x: shingle_set(x.as_py(), shingle))
    twice, common = (spark.sparkContext.broadcast(x) for x in (bitmap, sketch))
    del bitmap, sketch

    def sets_of(batches):
        import xxhash

        seen: set[int] = set()
        for batch in bloom.parts(batches):
            keys, sizes, fps, prefixes, codes = [], [], [], [], []
            for text in batch.column(2):
                own = shingle_set(text.as_py(), shingle)
                key = xxhash.xxh3_64_intdigest(own.tobytes())
                recurs, often = recurring.find(twice.value, common.value, own)
                again, often = own[recurs], often[recurs]
                most = prefix_length(len(own), similarity) - (len(own) - len(again))
                keys.append(key)
                sizes.append(len(own))
                if most <= 0 or key in seen:
                    fps.append(None)
                    prefixes.append(None)
                    codes.append(None)
                    continue
                seen.add(key)
                rank = np.lexsort((again, often))
                fps.append(int(np.uint64(fold_bits(own)).view(np.int64)))
                prefixes.append(again[rank[:most]].view(np.int64))
                codes.append(again.tobytes())
            if len(seen) > REMEMBERED:
                seen.clear()
            columns = [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(fps, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "text_hash", "set_key", "n", "fp", "prefix", "codes"])

    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(3), F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    rows = scratch.table(keyed.mapInArrow(sets_of, f"id {id_type}, text_hash long, set_key long, n int, fp long, prefix array<long>, codes binary"), "rows")
    for held in (twice, common):
        held.destroy()  # else every worker keeps them
    sending = rows.where(F.col("fp").isNotNull())
    sent = sending.select(F.explode("prefix").alias("hash"), "set_key").distinct()
    least = sent.groupBy("hash").agg(F.min("set_key").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    links = sent.join(least, "hash").select(F.col("set_key").alias("a"), "b").where("a <> b").distinct()
    points = scratch.table(sending.select("fp", "set_key").distinct(), "fingerprints")
    firsts = scratch.table(points.groupBy("fp").agg(F.min("set_key").alias("first")), "distinct")
    close = fingerprint_links(firsts.select("fp"), max_bits, scratch, firsts.count())
    ends = [firsts.select(F.col("fp").alias(f"fp_{x}"), F.col("first").alias(x)) for x in ("a", "b")]
    close = close.select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b")).join(ends[0], "fp_a").join(ends[1], "fp_b").select("a", "b")
    same = points.join(firsts, "fp").where("set_key <> first").select(F.col("set_key").alias("a"), F.col("first").alias("b"))
    links = scratch.table(links.unionByName(close).unionByName(same), "links")
    labels = scratch.table(components(links, scratch), "labels").withColumnRenamed("node", "set_key")

    # Blocks of large components meet two by two.
    blocks = labels.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64(F.lit(17), "set_key"), F.col("blocks")).cast("int")
    held = labels.join(blocks, "label").select("set_key", "label", "blocks", own.alias("own"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: (i != F.col("own")) | (F.col("blocks") == 1))
    dealt = held.withColumn("other", F.explode(others)).select("set_key", "label", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("blocks") > 1).alias("split"))
    sets = sending.groupBy("set_key").agg(F.first("n").alias("n"), F.first("codes").alias("codes"))
    together = dealt.join(sets, "set_key")

    def confirmed(table: pa.Table) -> pa.Table:
        keys = table.column("set_key").to_numpy()
        order = np.argsort(keys)
        found = table.column("codes").combine_chunks()
        root = exact_links([np.frombuffer(found[int(i)].as_py(), np.uint64) for i in order], table.column("n").to_numpy()[order].astype(np.int64), similarity)
        keys = keys[order]
        linked = keys != keys[root]
        split = pa.array(np.full(int(linked.sum()), bool(table.column("split")[0].as_py())))
        return pa.table({"a": pa.array(keys[linked]), "b": pa.array(keys[root][linked]), "split": split})

    exact = scratch.table(together.groupBy("label", "low", "high").applyInArrow(confirmed, "a long, b long, split boolean"), "exact")
    classes = exact.where("NOT split").select(F.col("a").alias("set_key"), F.col("b").alias("class_fp"))
    split = exact.where("split").select("a", "b")
    if split.limit(1).count():
        whole = components(split, scratch).where("node <> label")
        classes = classes.unionByName(whole.select(F.col("node").alias("set_key"), F.col("label").alias("class_fp")))
    classes = scratch.table(classes, "classes")
    for done in ("fingerprints", "distinct", "links", "labels", "exact"):
        scratch.drop(done)
    return rows.select("id", "text_hash", "set_key").join(classes, "set_key", "left").select("id", "text_hash", F.coalesce("class_fp", "set_key").alias("class_fp"))
