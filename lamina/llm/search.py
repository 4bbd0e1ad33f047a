"""Exact top-k BM25 search over sharded inverted indexes with block-max WAND pruning.

Each task turns the documents it reads into shards.  A shard's documents are clustered by their frequent words; a
cluster is a range of documents, ordered by length, with frequent words of its own.  The index stores the largest impact
of each of them in its range (the block maxima), their counts by document, and postings of the other words.  Texts are
not shuffled; document frequencies, the number of documents and their mean length are global, so scores of different
shards compare.

Within a shard the lists of a query's other words, which are short, are added up for some queries together.  Where a
range's largest sum and its block maxima stay below a query's threshold, the range is skipped (the WAND condition).  In
the ranges left, what frequent words add comes from one matrix product for many queries, in single precision and with
room for it; only documents whose bound reaches the threshold are scored exactly.

Queries go through the shards in bounded blocks and in rounds over growing shares of the shards.  A query enters a
round with the k-th best score so far as its threshold, so later shards send on only what may still be among the best.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, word_count

K1, B = 1.2, 0.75
#: Documents of a range at least (smaller clusters share one).
RANGE_DOCS = 512
#: Postings of a shard, about, and documents at most; they bound what a task holds.
SHARD_POSTINGS, SHARD_DOCS = 3_000_000, 60_000
#: Documents are clustered by words in more than a share of a shard's documents, in so many rounds.
CLUSTER_SHARE, ROUNDS = 1 / 8, 6
#: A range's frequent words: those in more than a share of its documents and in more than a few, the most frequent at
#: most.  They and the shard's documents make so many cells at most.
FREQUENT_SHARE, FEW, FREQUENT, CELLS = 1 / 16, 16, 768, 8_000_000
#: Postings of other words that are added up at once, about.
LONG = 100_000
#: Query terms broadcast at once, about (4 bytes each and 16 a distinct one), and queries and bounds made at once.
BLOCK_TERMS, AT_ONCE, AT_ONCE_BOUNDS = 2_000_000, 256, 2_500_000
#: Scores are compared after rounding to so many digits.
DIGITS = 6
KINDS = {
    "ids": np.int64, "lengths": np.int64, "terms": np.uint64, "starts": np.int64, "lists": np.int64, "docs": np.uint16, "counts": np.int32,
    "ranges": np.int64, "frequent": np.int64, "maxima": np.float64, "rows": np.int16, "places": np.uint16, "often": np.int32,
}
INDEX = ", ".join(["share double", *(f"{name} binary" for name in KINDS)])


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """64-bit hashes of the distinct lower-cased (A-Z) words, their counts, and the number of words."""
    import xxhash

    words = text.encode("utf-8").lower().split() if text else []
    h, n = np.unique(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), return_counts=True)
    return h, n, len(words)


def impact(count: np.ndarray, length: np.ndarray, mean_length: float) -> np.ndarray:
    return count * (K1 + 1) / (count + K1 * (1 - B + B * length / max(mean_length, 1e-9)))


def _clusters(docs: np.ndarray, codes: np.ndarray, n_docs: int, n_codes: int, k: int = 12) -> np.ndarray:
    """A cluster for each document by its frequent words: spherical k-means from random documents."""
    held = np.zeros((n_docs, n_codes), np.float32)
    held[docs, codes] = 1
    held /= np.maximum(np.sqrt(held.sum(1, keepdims=True)), 1)
    centres = held[np.random.default_rng(0).permutation(n_docs)[:k]]
    for _ in range(ROUNDS):
        own = (held @ centres.T).argmax(1)
        sums = np.stack([held[own == c].sum(0) for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return (held @ centres.T).argmax(1)


def build_shard(ids: list, lengths: list[int], terms: list[np.ndarray], counts: list[np.ndarray], mean_length: float) -> dict[str, np.ndarray]:
    """The arrays of one shard, by the names of ``KINDS``."""
    n_docs, sizes = len(ids), [len(t) for t in terms]
    term, doc, count, length = np.concatenate(terms), np.repeat(np.arange(n_docs), sizes), np.concatenate(counts), np.array(lengths, np.int64)
    found, code = np.unique(term, return_inverse=True)
    df, n_terms = np.bincount(code, minlength=len(found)), len(found)
    own = np.zeros(n_docs, np.int64)
    typical = np.argsort(-df, kind="stable")[: min(256, int((df > max(FEW, CLUSTER_SHARE * n_docs)).sum()))]
    if len(typical):
        place = np.full(n_terms, -1)
        place[typical] = np.arange(len(typical))
        of = place[code]
        own = _clusters(doc[of >= 0], of[of >= 0], n_docs, len(typical))
    size = np.bincount(own)
    _, own = np.unique(np.where(size[own] < RANGE_DOCS, -1, own), return_inverse=True)  # small clusters are one range
    order = np.lexsort((length, own))
    at = np.empty(n_docs, np.int64)
    at[order] = np.arange(n_docs)
    ids, length, own, doc = [ids[i] for i in order], length[order], own[order], at[doc].astype(np.uint16)
    size = np.bincount(own)
    n_ranges = len(size)
    held = np.bincount(own[doc] * n_terms + code, minlength=n_ranges * n_terms).reshape(n_ranges, n_terms)
    frequent, place = np.full((n_ranges, min(FREQUENT, CELLS // n_docs)), -1), np.full((n_ranges, n_terms), -1, np.int16)
    for r in range(n_ranges):
        many = np.flatnonzero(held[r] > max(FEW, FREQUENT_SHARE * size[r]))
        many = many[np.argsort(-held[r, many], kind="stable")][: frequent.shape[1]]
        frequent[r, : len(many)], place[r, many] = many, np.arange(len(many))
    frequent = frequent[:, : int((frequent >= 0).sum(1).max())]
    row = place[own[doc], code]
    often, rare = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
    where = doc[often]
    maxima = np.zeros(frequent.size)
    np.maximum.at(maxima, row[often].astype(np.int64) * n_ranges + own[where], impact(count[often], length[where], mean_length))
    rare = rare[np.argsort(code[rare], kind="stable")]
    known, raw = np.array([i is not None for i in ids], np.int64), np.array([i or 0 for i in ids], np.int64)
    starts = lambda number: np.append(0, np.cumsum(number))
    return {
        "ids": np.stack([raw, known]), "lengths": length, "terms": found, "starts": starts(df), "lists": starts(np.bincount(code[rare], minlength=n_terms)), "docs": doc[rare], "counts": count[rare].astype(np.int32),
        "ranges": starts(size), "frequent": frequent, "maxima": maxima, "rows": row[often], "places": where, "often": count[often].astype(np.int32),
    }


def _index(mean_length: float):
    def run(batches):
        import zlib

        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        ids, lengths, terms, counts, held = [], [], [], [], 0

        def shard():
            parts = build_shard(ids, lengths, terms, counts, mean_length)
            share = zlib.crc32(parts["ids"].tobytes()) / (1 << 32)
            return pa.RecordBatch.from_arrays([pa.array([share]), *(pa.array([squeeze(parts[k].tobytes())], pa.binary()) for k in KINDS)], ["share", *KINDS])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                h, n, size = term_counts(text.as_py())
                ids.append(key.as_py())
                lengths.append(size)
                terms.append(h)
                counts.append(n)
                held += len(h)
                if held > SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                    yield shard()
                    ids, lengths, terms, counts, held = [], [], [], [], 0
        if ids:
            yield shard()

    return run


def _load(row: dict, name: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(row[name]), KINDS[name])


def _frequencies(batches):
    for batch in batches:
        for row in batch.to_pylist():
            t, n = _load(row, "terms").view(np.int64), np.diff(_load(row, "starts"))
            for i in range(0, len(t), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(t[i : i + (1 << 16)]), pa.array(n[i : i + (1 << 16)])], ["term", "n"])


class Shard:
    """One shard: each range's frequent words with their block maxima and counts by document, and lists of the others."""

    def __init__(self, row: dict, mean_length: float):
        self.ids, self.known = _load(row, "ids").reshape(2, -1)
        self.lengths, self.terms, self.starts, self.lists, self.docs, counts, self.ranges = (_load(row, k) for k in ("lengths", "terms", "starts", "lists", "docs", "counts", "ranges"))
        self.impacts, self.mean_length, n_ranges = impact(counts, self.lengths[self.docs], mean_length), mean_length, len(self.ranges) - 1
        frequent = _load(row, "frequent").reshape(n_ranges, -1)
        n_rows = frequent.shape[1]
        self.maxima = _load(row, "maxima").reshape(n_rows, n_ranges).astype(np.float32)
        rows, places, often = (_load(row, k) for k in ("rows", "places", "often"))
        cells = places * np.int64(n_rows + 1) + rows  # the last row is of words without one
        self.often, self.frequent = np.zeros((len(self.ids), n_rows + 1), np.int32), np.zeros((len(self.ids), n_rows + 1), np.float32)
        self.often.ravel()[cells] = often
        self.frequent.ravel()[cells] = impact(often, self.lengths[places], mean_length)
        words = np.unique(frequent[frequent >= 0])  # frequent in some range
        self.place = np.full(len(self.terms), -1)
        self.place[words] = np.arange(len(words))
        self.rows = np.full((n_ranges, len(words)), n_rows)  # a word's row in each range
        for r in range(n_ranges):
            of = frequent[r][frequent[r] >= 0]
            self.rows[r, self.place[of]] = np.arange(len(of))
        self.own = np.repeat(np.arange(n_ranges), np.diff(self.ranges))  # a document's range
        self.weight, self.added = np.zeros(len(self.terms)), np.zeros(len(self.docs))

    def weigh(self, terms: np.ndarray, idf: np.ndarray) -> None:
        """Multiplies the impacts of lists by the words' weights, which are the same in all queries."""
        if not np.array_equal(self.weight[terms], idf):
            self.weight[terms] = idf
            self.added = self.impacts * np.repeat(self.weight, np.diff(self.lists))

    def _sums(self, terms: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """What the lists of each query's words add to each document."""
        begin, n_docs = self.lists[terms], len(self.ids)
        size = self.lists[terms + 1] - begin
        before = np.append(0, np.cumsum(size))
        out, lo = np.empty((len(offsets) - 1, n_docs)), 0
        while lo < len(out):  # some queries together, with about ``LONG`` postings
            hi = max(lo + 1, int(np.searchsorted(before[offsets], before[offsets[lo]] + LONG, "right")) - 1)
            a, b = offsets[lo], offsets[hi]
            at = np.repeat(begin[a:b] - before[a:b], size[a:b])
            at += np.arange(before[a], before[b])
            key = np.repeat(np.arange(hi - lo) * n_docs, np.diff(before[offsets[lo : hi + 1]]))
            key += self.docs.take(at)
            # Without any posting bincount gives integers.
            out[lo:hi] = np.bincount(key, self.added.take(at), (hi - lo) * n_docs).reshape(hi - lo, n_docs)
            lo = hi
        return out

    def bounds(self, queries: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query what lists add to each document and, with room for single precision, bounds of whole scores.

        A range none of whose documents can reach a query's floor is skipped: its bounds are too low, but below the floor.
        """
        sizes = [len(t) for t, _ in queries]
        terms, idf = np.concatenate([t for t, _ in queries]), np.concatenate([w for _, w in queries])
        self.weigh(terms, idf)
        sums = self._sums(terms, np.append(0, np.cumsum(sizes)))
        out = sums.astype(np.float32)
        query, word = np.repeat(np.arange(len(queries)), sizes), self.place[terms]
        some = word >= 0
        query, word, idf = query[some], word[some], idf[some]
        for r, (a, b) in enumerate(zip(self.ranges.tolist(), self.ranges[1:].tolist(), strict=False)):
            weights = np.zeros((len(queries), len(self.maxima) + 1), np.float32)
            weights[query, self.rows[r, word]] = idf
            used = int((self.rows[r] < len(self.maxima)).sum())
            weights, part = weights[:, :used], out[:, a:b]
            need = np.arange(len(queries))
            if floors is not None:
                need = np.flatnonzero((weights @ self.maxima[:used, r] + part.max(1)) * (1 + 1e-4) >= floors - 10.0**-DIGITS)
            part[need] += weights[need] @ self.frequent[a:b, :used].T
        out *= np.float32(1 + 1e-4)
        return list(zip(sums, out, strict=True))

    def top(self, terms: np.ndarray, idf: np.ndarray, k: int, floor: float, made: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that may be among the k best, all with rounded scores of at least ``floor``."""
        sums, bound = made
        low = max(floor - 10.0**-DIGITS, 1e-12)  # a score may be less than what it is rounded to
        found = np.flatnonzero(bound >= low)
        if not len(found):
            return found, np.zeros(0)
        place = self.place[terms]
        rows, weights = self.rows[:, place[place >= 0]], idf[place >= 0]

        def scores_of(docs: np.ndarray) -> np.ndarray:
            counts = self.often[docs[:, None], rows[self.own[docs]]]
            return np.round(sums[docs] + impact(counts, self.lengths[docs][:, None], self.mean_length) @ weights, DIGITS)

        if len(found) > 4 * k:
            order = np.argpartition(bound[found], len(found) - 4 * k)
            found, later = found[order[len(found) - 4 * k :]], found[order[: len(found) - 4 * k]]
            scores = scores_of(found)
            least = max(floor, float(np.partition(scores, -k)[-k]))
            later = later[bound[later] >= least - 10.0**-DIGITS]
            found, scores = np.concatenate([found, later]), np.concatenate([scores, scores_of(later)])
        else:
            scores = scores_of(found)
        keep = (scores >= floor) & (scores > 0)
        found, scores = found[keep], scores[keep]
        if len(found) > k:
            best = np.lexsort((self.ids[found], -self.known[found], -scores))[:k]
            found, scores = found[best], scores[best]
        return found, scores


def _search(block, mean_length: float, k: int):
    """``block``: a broadcast (query ids, offsets, distinct terms, their idf, each query's terms as places, floors)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, distinct, idf, places, floors = block.value  # tasks without a shard don't load it
                shard = Shard(row, mean_length)
                if not len(shard.terms):
                    continue
                at = np.minimum(np.searchsorted(shard.terms, distinct), len(shard.terms) - 1)
                at = np.where(shard.terms[at] == distinct, at, -1)
                shard.weigh(at[at >= 0], idf[at >= 0])
                at_once = max(1, min(AT_ONCE, AT_ONCE_BOUNDS // len(shard.ids)))
                for lo in range(0, len(ids), at_once):
                    some, query, doc, score = range(lo, min(lo + at_once, len(ids))), [], [], []
                    own = [places[offsets[q] : offsets[q + 1]] for q in some]
                    own = [p[at[p] >= 0] for p in own]
                    asked = [(at[p], idf[p]) for p in own]
                    for q, (t, w), bounds in zip(some, asked, shard.bounds(asked, floors[lo : lo + at_once]), strict=True):
                        if len(t):
                            docs, found = shard.top(t, w, k, floors[q], bounds)
                            query += [ids[q]] * len(docs)
                            doc += [int(i) if yes else None for i, yes in zip(shard.ids[docs], shard.known[docs], strict=True)]
                            score += found.tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.float64())], ["query_id", "id", "score"])

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id: str = "doc_id", query_text: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(query_id, id, score, rank): for each query the k documents of highest BM25 score, ties by id.

    Words are lower-cased (A-Z) and split at ASCII white space; a query counts each distinct word of its whole text
    once.  Documents without a word of the query don't match, so a query may have fewer than k rows; null and empty
    texts match nothing.  Queries of one id are one query; null query ids are none; null document ids are found and
    come last among ties.  Repeated rows are separate documents.  Empty tables give no rows; other columns play no part.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    n_docs, total = docs.agg(F.count(F.lit(1)), F.sum(word_count(F.col(text_col)))).first()
    mean_length = (total or 0) / max(1, n_docs)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    index = scratch.table(source.mapInArrow(_index(mean_length), INDEX), "index", maxRecordsPerFile=4)  # a shard is large

    def query_terms(batches):
        for batch in batches:
            who, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                h = term_counts(text.as_py())[0]
                who.append(np.full(len(h), key.as_py(), np.int64))
                terms.append(h)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(who)), pa.array(np.concatenate(terms).view(np.int64))], ["query_id", "term"])

    asked = queries.where(F.col(query_id).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_text).alias("text")).mapInArrow(query_terms, "query_id long, term long")
    asked = scratch.table(asked.distinct(), "terms")
    wanted = asked.select("term").distinct()
    df = index.select("terms", "starts").mapInArrow(_frequencies, "term long, n long").join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    idf = F.log(1 + (F.lit(float(n_docs)) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    n_blocks = -(-asked.count() // block_terms)
    number = F.pmod(F.xxhash64(F.lit(23), "query_id"), F.lit(max(1, n_blocks))).cast("int").alias("block")
    weighted = asked.join(df, "term").groupBy("query_id").agg(F.collect_list("term").alias("terms"), F.collect_list(idf).alias("idf"))  # a query's own words
    weighted = scratch.table(weighted.select("query_id", "terms", "idf", number), "asked")
    n_shards = index.count()
    edges = [0.0, min(1.0, 8 / max(1, n_shards))]
    while edges[-1] < 1:
        edges.append(min(1.0, edges[-1] * 4))
    done = []
    for b in range(n_blocks):
        block = weighted.where(F.col("block") == b).toArrow().combine_chunks()  # about ``block_terms`` terms
        if not block.num_rows:
            continue
        sizes = np.array(block.column("terms").combine_chunks().value_lengths())
        flat = lambda c: block.column(c).combine_chunks().flatten().to_numpy()
        distinct, first, places = np.unique(flat("terms").view(np.uint64), return_index=True, return_inverse=True)
        part = block.column("query_id").to_numpy(), np.concatenate([[0], np.cumsum(sizes)]), distinct, flat("idf")[first], places.astype(np.int32)
        floors, hits = np.zeros(block.num_rows), None
        for step, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            shared = spark.sparkContext.broadcast((*part, floors))
            some = index.where((F.col("share") >= lo) & (F.col("share") < (hi if hi < 1 else 2)))
            new = some.mapInArrow(_search(shared, mean_length, k), "query_id long, id long, score double")
            best = scratch.table(_best(new if hits is None else hits.unionByName(new), k).select("query_id", "id", "score", "rank"), f"hits-{b}-{step}")
            if step:
                scratch.drop(f"hits-{b}-{step - 1}")
            hits = best.drop("rank")
            if hi < 1:
                kth = {r.query_id: r.score for r in best.where(F.col("rank") == k).select("query_id", "score").collect()}  # one row a query of the block
                floors = np.array([kth.get(q, 0.0) for q in part[0].tolist()])
            shared.destroy()
        done.append(best)
    for table in ("index", "terms", "asked"):
        scratch.drop(table)
    if not done:
        return spark.createDataFrame([], "query_id long, id long, score double, rank int")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
