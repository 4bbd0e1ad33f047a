"""The pipeline's stages against what each is to do with its own input."""

import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from lamina.llm import bloom, jaccard, packing, quality, tokens
from lamina.llm.common import Scratch
from lamina.llm.queries import vocabulary
from test_operators import brute_classes, brute_fingerprint, words


def test_stages(spark, sf):
    docs, scratch = spark.read.parquet(f"{sf}/documents.parquet"), Scratch(spark, "test")
    names, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = scratch.table(stage(spark, docs, sf), f"s{k}")
        assert k == 4 or out.columns == names
        kept.append((docs.collect(), out.collect()))
        docs = out
    piece, is_byte = quality._vocabulary(vocabulary("piece_bpe_32k.model"))
    bands = quality.BANDS | quality.calibrate(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), vocabulary("piece_bpe_32k.model"))
    before, after = kept[0]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if quality.assess(r.text, r.lang, piece, is_byte, bands)[-1]}
    before, after = kept[1]
    assert {r.doc_id: r.text for r in after} == brute_first_lines({r.doc_id: r.text for r in before}, 10) and all(r.n_chars == len(r.text) for r in after)
    before, after = kept[2]
    least: dict[int, int] = {}
    for r, root in zip(before, brute_similar([r.text for r in before]), strict=True):
        least[root] = min(r.doc_id, least.get(root, r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(least.values())
    before, after = kept[3]
    copies = Counter(r.doc_id for r in after)
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 3
    before, after = kept[4]
    lengths = tokens.encoder(vocabulary("byte_bpe_50k.json")).encode([r.text for r in before])
    assert sum(r.length for r in after) == sum(len(x) + 1 for x in lengths)
    assert Counter((r.doc_id, r.length) for r in corpus_pipeline.run(spark, sf).collect()) == Counter((r.doc_id, r.length) for r in after)


def brute_first_lines(texts, least):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    n, met, out = Counter(k for t in texts.values() for k in {key(x) for x in t.split("\n")} if k), set(), {}
    for i in sorted(texts):
        kept = []
        for line in texts[i].split("\n"):
            if n[key(line)] < least or key(line) not in met:
                kept.append(line)
            if n[key(line)] >= least:
                met.add(key(line))
        out[i] = "\n".join(kept)
    return out


def test_empty_documents(spark, tmp_path, sf):
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def brute_similar(texts, similarity=0.8):
    sets = []
    for t in texts:
        w = words((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def near_copies():
    """Copies with more and more words changed, chains of them, exact copies, passages in common, empty texts."""
    rng, texts = random.Random(8), [None, "", "one two", "One  two"]
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(30)]
    for k in range(30):
        base = [word() for _ in range(rng.randint(20, 160))] + passage * (k % 3 == 0)
        texts += [" ".join(base)] * (1 + k % 2)
        for n in (1, 2, 3, 5, 8):
            base = list(base) if n % 2 else base  # some follow from the copy before
            for _ in range(n):
                base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    return texts


def test_near_dedup_equals_brute_jaccard(spark):
    texts = near_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    root = brute_similar(texts)
    found = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in found.collect()) == sorted(set(root))
    assert len(set(root)) < len(set(brute_classes([brute_fingerprint(t) for t in texts])))
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_exact_links():
    sets = [np.unique(np.fromiter((zlib.crc32(" ".join(w[i : i + 5]).encode()) for i in range(max(0, len(w) - 4))), np.uint64)) for w in (words(t) for t in near_copies()[4:])]
    wanted = [min(j for j, r in enumerate(brute) if r == x) for brute in [brute_similar(near_copies()[4:])] for x in brute]
    assert jaccard.exact_links(sets, np.array(list(map(len, sets))), 0.8).tolist() == wanted and jaccard.exact_links([], np.zeros(0, np.int64), 0.8).tolist() == []


def test_blocks_of_a_large_component_lose_no_link(spark):
    texts = near_copies()
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[5])], "doc_id long, text string").repartition(3)
    root = brute_similar([*texts, texts[5]])
    found = jaccard.similar_documents(docs, block=4).collect()
    ids = list(range(len(texts))) + [None]
    classes = {}
    for r in found:
        classes.setdefault(r.class_fp, []).append(r.id)
    wanted = {}
    for i, r in zip(ids, root, strict=True):
        wanted.setdefault(r, []).append(i)
    order = lambda c: sorted(sorted(x, key=lambda i: (i is None, i)) for x in c.values() if None not in x)
    assert order(classes) == order(wanted) and len(found) == len(ids)


def test_one_of_many_copies_keeps_its_text(spark, sf, tmp_path):
    text = "The committee met on Tuesday to discuss the budget.\nAfter a short break most members agreed that the new library should open before winter.\nNobody objected to the plan."
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    row = docs.limit(1).drop("doc_id", "text")
    copies = spark.range(90_000, 90_015).withColumnRenamed("id", "doc_id").crossJoin(row).withColumn("text", F.lit(text)).select(docs.columns)
    docs.where("doc_id < 20").unionByName(copies).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = Scratch(spark, "test").table(stage(spark, docs, str(tmp_path)), "stage")
    kept = docs.where("doc_id >= 90000 AND text <> ''").collect()  # the emptied copies are one empty row
    assert [(r.doc_id, r.text, r.n_chars) for r in kept] == [(90_000, text, len(text))]
    packed = {r.doc_id: r.length for r in corpus_pipeline.run(spark, str(tmp_path)).where("doc_id >= 90000").collect()}
    assert packed[90_000] == len(tokens.encoder(vocabulary("byte_bpe_50k.json")).encode([text])[0]) + 1


def test_texts_of_their_own_send_nothing_however_many(spark, monkeypatch):
    """A filter far smaller than the corpus, as 32 MB are for 6 GB: texts without a copy still send no shingles."""
    rng = random.Random(4)
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(300)] for _ in range(2500)]
    texts += [[*texts[3][:-1], "end"], texts[9]]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(bloom, "MOST_BITS", bloom.BLOCK * 8)
    sending, table = [], Scratch.table

    def watched(self, df, name, **options):
        out = table(self, df, name, **options)
        if name == "rows" and "fp" in df.columns:
            sending.append(out.where("fp IS NOT NULL").count())
        return out

    monkeypatch.setattr(Scratch, "table", watched)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()}
    assert kept == set(range(2500))
    assert sending[0] < 100, sending


def test_counts_of_hashes_are_exact(spark):
    rng = np.random.default_rng(2)
    once, often = (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for n in (30_000, 3000))
    times = 2 + np.arange(len(often)) % 40
    sent = np.concatenate([once, np.repeat(often, times)])
    rng.shuffle(sent)
    rows = spark.createDataFrame([(x.tobytes(),) for x in np.array_split(sent, 300)], "h binary").repartition(3)
    told = bloom.Recurring(1 << 23, 4)  # eight shards
    bitmap, sketch = told.count(rows, lambda x: np.frombuffer(x.as_py(), np.uint64))
    recurs, count = told.find(bitmap, sketch, often)
    assert recurs.all() and (count >= (4 * np.log2(times)).astype(int)).all() and (count == (4 * np.log2(times)).astype(int)).mean() > 0.9
    assert told.find(bitmap, sketch, once)[0].mean() < 0.02
