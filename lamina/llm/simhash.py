"""SimHash near-dedup: fingerprints in a vantage-point tree.

A document's fingerprint has bit i set if it is set in more than half of its shingles' hashes.  Distinct fingerprints
are dealt to shards by the leaves of a vantage-point tree over Hamming distance, which the driver builds from a bounded
sample: a node holds a vantage fingerprint and a radius; those within the radius go one way and the rest the other.  By
the triangle inequality a fingerprint's neighbours within k bits lie across the radius only if its own distance is
within k of it, so a fingerprint is also sent, as a query, to the leaves across the boundaries it lies near.  Of two
leaves only the earlier one's fingerprints visit the other.  Each shard searches its own tree the same way, links the
exact pairs and sends on one link a fingerprint, never all pairs.  Components come from the links of all shards.

A query near many boundaries visits many shards: with fingerprints spread evenly over 64 bits, visits grow about as the
number of shards to the power 0.7.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .components import components

#: Fingerprints from which the driver builds the tree, at most; where it has too few leaves for all fingerprints, samples
#: of its leaves deepen it.  All fingerprints are then dealt out by it.
SAMPLE = 20_000
#: Fingerprints of a shard, about.
SHARD = 6_000
#: A shard's own search compares all pairs where these are fewer.
PAIRS = 1 << 21


def shingle_hashes(text: str | None, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """The hash of each of a whole text's shingles, in order; none if it has no word."""
    import xxhash

    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.zeros(0, np.dtype("<u8"))
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    n = max(1, len(words) - shingle + 1)
    stops = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    return np.fromiter((hashed(joined[a:b], seed) for a, b in zip(starts, stops, strict=False)), np.dtype("<u8"), n)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a whole text; zero if it has no word."""
    return fold_bits(shingle_hashes(text, shingle, seed))


def fold_bits(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes."""
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i : i + (1 << 15)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def build_tree(sample: np.ndarray, leaves: int, k: int, seed: int = 5) -> list[tuple]:
    """Nodes (vantage, radius, near, far) with negative numbers for leaves: -1 is leaf 0.

    Of some vantage points and all radii the node takes those that send the fewest queries both ways.
    """
    rng = np.random.default_rng(seed)
    nodes: list[tuple] = []
    made = [0]

    def leaf() -> int:
        made[0] += 1
        return -made[0]

    def grow(points: np.ndarray, wanted: int) -> int:
        if wanted <= 1 or len(points) < 8:
            return leaf()
        best = None
        for v in rng.choice(points, min(24, len(points)), replace=False):
            counts = np.bincount(distance(points, v), minlength=65 + 2 * k)
            upto = np.cumsum(counts)
            for r in range(64):
                near = upto[r] / len(points)
                if 0.25 <= near <= 0.75 or best is None and 0 < near < 1:
                    both = (upto[min(r + k, 64)] - (upto[r - k] if r >= k else 0)) / len(points)
                    cost = (both + abs(near - 0.5) * 0.2) + 10 * (not 0.25 <= near <= 0.75)
                    if best is None or cost < best[0]:
                        best = cost, v, r, near
        if best is None:
            return leaf()
        _, v, r, near = best
        at = len(nodes)
        nodes.append(())
        inside = distance(points, v) <= r
        share = min(wanted - 1, max(1, round(wanted * near)))
        nodes[at] = (int(v), r, grow(points[inside], share), grow(points[~inside], wanted - share))
        return at

    grow(np.sort(sample), leaves)
    return nodes


def graft(nodes: list[tuple], subtrees: dict[int, list[tuple]]) -> list[tuple]:
    """The tree with ``subtrees`` in place of leaves (by number from 0); leaves are numbered anew."""
    if not nodes:
        return subtrees.get(0, [])
    out, made = list(nodes), 0

    def placed(leaf: int) -> int:
        nonlocal made
        offset, sub = len(out), subtrees.get(leaf, [])
        if not sub:
            made += 1
            return -made
        for v, r, *ends in sub:
            new = []
            for end in ends:
                made += end < 0
                new.append(end + offset if end >= 0 else -made)
            out.append((v, r, *new))
        return offset

    for i, (v, r, *ends) in enumerate(nodes):
        out[i] = (v, r, *(end if end >= 0 else placed(-end - 1) for end in ends))
    return out


def n_leaves(nodes: list[tuple]) -> int:
    return sum(end < 0 for node in nodes for end in node[2:]) or 1


def route(points: np.ndarray, nodes: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, index of the point, whether it is at home there) for all leaves a point has to visit."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def down(at: int, idx: np.ndarray, home: np.ndarray) -> None:
        if not len(idx):
            return
        if at < 0 or not nodes:
            found.append((np.full(len(idx), -at - 1 if at < 0 else 0), idx, home))
            return
        v, r, near, far = nodes[at]
        d = distance(points[idx], np.uint64(v))
        for child, inside, visit in ((near, d <= r, d <= r + k), (far, d > r, d > r - k)):
            down(child, idx[visit], (home & inside)[visit])

    down(0, np.arange(len(points)), np.ones(len(points), bool))
    leaf, idx, home = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    own = np.zeros(len(points), np.int64)
    own[idx[home.astype(bool)]] = leaf[home.astype(bool)]
    keep = leaf >= own[idx]
    return leaf[keep], idx[keep], home[keep].astype(bool)


def link(home: np.ndarray, visiting: np.ndarray, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, smallest of its group) that join all points within k bits, home or visiting, of a home point."""
    points = np.concatenate([home, visiting])
    rng = np.random.default_rng(seed)
    parent = list(range(len(points)))
    label = np.arange(len(points))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def compare(h: np.ndarray, q: np.ndarray) -> None:
        nonlocal label
        for i in range(0, len(h), max(1, PAIRS // max(1, len(q)))):
            rows = h[i : i + max(1, PAIRS // max(1, len(q)))]
            a, b = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[q][None, :]) <= k)
            a, b = label[rows[a]], label[q[b]]
            if not (new := a != b).any():
                continue
            for x, y in np.unique(np.stack([np.minimum(a, b)[new], np.maximum(a, b)[new]], 1), axis=0).tolist():
                x, y = find(x), find(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            roots = np.unique(label)
            to = np.arange(len(points))
            to[roots] = [find(x) for x in roots.tolist()]
            label = to[label]

    def search(h: np.ndarray, q: np.ndarray) -> None:
        if not len(h) or not len(q):
            return
        if len(h) * len(q) > PAIRS and len(h) > 256:
            v = points[rng.choice(h)]
            dh, dq = distance(points[h], v), distance(points[q], v)
            r = int(np.median(dh))
            if (dh <= r).all():
                r -= 1
            if (dh <= r).any():
                search(h[dh <= r], q[dq <= r + k])
                search(h[dh > r], q[dq > r - k])
                return
        compare(h, q)

    search(np.arange(len(home)), np.arange(len(points)))
    least = np.full(len(points), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, label, points)
    root = least[label]
    apart = root != points
    return points[apart], root[apart]


def fingerprints(docs: DataFrame, text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """A long column; its bits are the fingerprint's."""

    @F.pandas_udf("long")
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, shingle, seed) for t in texts), np.uint64, len(texts)).view(np.int64))

    return made(text)


#: Fingerprints of a leaf from which its subtree is built, about, and of all leaves together at most.
LEAF_SAMPLE, LEVEL_SAMPLE = 160, 2_000_000


def _subtrees(distinct: DataFrame, nodes: list[tuple], n: int, shard: int, k: int, least: int) -> dict[int, list[tuple]]:
    """A subtree for each leaf that holds more than a shard, from a sample of about ``LEAF_SAMPLE`` fingerprints a leaf."""
    per_leaf = min(max(LEAF_SAMPLE, least), max(16, LEVEL_SAMPLE // n_leaves(nodes)))
    every = max(1, n // (n_leaves(nodes) * per_leaf))
    drawn = distinct.where(F.pmod(F.xxhash64(F.lit(29), "fp"), F.lit(every)) == 0).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    leaf, idx, home = route(drawn, nodes, 0)
    found = {}
    for x in np.unique(leaf[home]).tolist():
        points = drawn[idx[home & (leaf == x)]]
        wanted = -(-len(points) * every // shard)
        if wanted > 1:
            found[x] = build_tree(points, wanted, k)
    return found


def fingerprint_links(distinct: DataFrame, k: int, scratch: Scratch, n: int, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(fp) distinct longs -> (a, b) links whose components are those of all pairs within k bits."""
    some = distinct.orderBy(F.xxhash64("fp")).limit(sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    nodes = build_tree(some, -(-n // shard), k)
    while n > 2 * shard * n_leaves(nodes):
        # More fingerprints than the sample has leaves for: a sample of each leaf deepens the tree there.
        deeper = graft(nodes, _subtrees(distinct, nodes, n, shard, k, least=max(16, sample // max(1, n_leaves(nodes)))))
        if n_leaves(deeper) <= n_leaves(nodes):
            break
        nodes = deeper

    def deal(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            leaf, idx, home = route(points, nodes, k)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(points[idx].view(np.int64), pa.int64()), pa.array(home, pa.bool_())], ["leaf", "fp", "home"])

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        points, home = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["home"].to_numpy(bool)
        a, b = link(points[home], points[~home], k)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.mapInArrow(deal, "leaf int, fp long, home boolean").groupBy("leaf").applyInPandas(pairs, "a long, b long")


def near_duplicates(docs: DataFrame, max_bits: int = 3, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """(id, text_hash, fp, class_fp, component_id) for every row; ``class_fp`` tells components without an id apart.

    A-Z are lower-cased, words are runs of code points other than ASCII white space, shingles are ``shingle`` words
    (all words of a shorter text).  Texts without a word have fingerprint 0 and link like any other.  ``component_id``
    is the smallest id reachable over links of at most ``max_bits`` differing bits, the row's own included; null ids
    don't count, and a component without any other has a null id.  Repeated rows each give their row; an empty table
    gives none.  ``text_hash`` tells rows that share an id apart.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(3), F.col(text_col)).alias("text_hash"), fingerprints(docs, F.col(text_col), shingle, seed).alias("fp"))
    rows = scratch.table(keyed, "rows")
    distinct = scratch.table(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    links = scratch.table(fingerprint_links(distinct.select("fp"), max_bits, scratch, distinct.count(), shard, sample).distinct(), "pairs")
    labels = scratch.table(components(links, scratch), "labels")
    own = distinct.join(labels, distinct["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    class_ids = own.groupBy("label").agg(F.min("least").alias("component_id"))
    by_fp = scratch.table(own.join(class_ids, "label").select("fp", "label", "component_id"), "classes")
    for done in ("distinct", "pairs", "labels"):
        scratch.drop(done)
    return rows.join(by_fp, "fp").select("id", "text_hash", "fp", F.col("label").alias("class_fp"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float | None = None, **options) -> DataFrame:
    """One row of each component, with its columns: the smallest id's, null ids last, by text where ids repeat.

    Components are those of fingerprints within ``max_bits``; with ``similarity`` they are those of all pairs whose
    shingle sets have that Jaccard similarity or more, for which fingerprints only find a part of the candidates.  Of
    rows that repeat in id and text one stays.
    """
    if similarity is None:
        find = near_duplicates
    else:
        from .jaccard import similar_documents as find

        options["similarity"] = similarity
    classed = find(docs, id_col=id_col, text_col=text_col, **options)
    scratch = Scratch(docs.sparkSession, "one-of-each")
    classed = scratch.table(classed, "classed")
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("text_hash"))
    least = classed.groupBy("class_fp").agg(F.min(order).alias("first"))
    stay = scratch.table(least.select(F.col("first.id").alias("stay_id"), F.col("first.text_hash").alias("stay_hash")), "stay")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col(id_col).alias("id"), F.xxhash64(F.lit(3), F.col(text_col)).alias("text_hash"))
    out = packed.join(stay, F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("text_hash") == F.col("stay_hash")), "left_semi")
    repeated = classed.groupBy("id", "text_hash").count().where("count > 1").limit(1).count()
    if repeated:  # rows that repeat in id and text
        out = out.dropDuplicates(["id", "text_hash"])
    return out.select("kept.*")
