"""Every operator against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import duck, rows, same
from lamina.llm import bloom, components, language, lines, mixing, packing, passages, pii, quality, queries, search, simhash, tokens
from lamina.llm.common import Scratch
from lamina.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, size long, kept string, row string, id long, text_hash long, quality string"


def odd_rows():
    """Nulls in each column, empty and white texts, a very long text, repeated rows, ties, odd characters."""
    rng = random.Random(3)
    base = ["The cat sat on the mat and looked at it for a long while indeed.", "Der Hund lief durch den Wald und kam am Abend wieder nach Hause zurück."]
    texts = [None, "", "   \n\t ", "one", "Ab ab\n\nAB\n", "x\x1fy 　z ", "émile 北京 🙂  end", *base, *base, " ".join(rng.choice(["a", "bb", "ccc", "the"]) for _ in range(20_000))]
    texts += [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(rng.randint(1, 120))) for _ in range(60)]
    texts += [texts[-1] + " extra", texts[-1], texts[-1]]
    out = [(i, t, "de" if t and "und" in t else "en", rng.choice(["a", "b", "c", None]), 7, "k", "r", -1, 5, "q") for i, t in enumerate(texts)]
    return [*out, out[-1], out[-1], (None, "a null id here", None, None, 7, "k", "r", -1, 5, "q"), (None, "a null id here", None, None, 7, "k", "r", -1, 5, "q")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


# --- tokens and packing ---


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet=" \t\n\r 　 a1.'sé<|endoftext>", max_size=40))
def test_fast_ids_equal_the_library(text):
    from tokenizers import Tokenizer

    library = getattr(test_fast_ids_equal_the_library, "library", None) or Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    test_fast_ids_equal_the_library.library = library
    for t in (text, text + "<|endoftext|> x"):
        assert tokens.encoder(vocabulary("byte_bpe_50k.json")).encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids


def test_other_libraries():
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    assert tokens.encoder(vocabulary("piece_bpe_32k.model")).encode(["Hello 北京"])[0].tolist() == piece.encode("Hello 北京")
    a, b = (tokens.encoder(vocabulary(f"byte_bpe_50k.{x}")).encode(["Hello  world's 北京\n\n x"])[0].tolist() for x in ("json", "tiktoken"))
    assert a == b


def test_token_counts(odd, empty, tmp_path):
    path = vocabulary("byte_bpe_50k.json")
    found = Counter(map(tuple, tokens.token_counts(odd, path, str(tmp_path / "cache")).collect()))
    encode = tokens.encoder(path).encode
    assert found == Counter((r[0], len((r[1] or "").encode()), len(encode([r[1] or ""])[0])) for r in odd_rows())
    stored = odd.sparkSession.read.parquet(str(tmp_path / "cache")).count()
    assert stored == len({r[1] or "" for r in odd_rows()})
    assert Counter(map(tuple, tokens.token_counts(odd, path, str(tmp_path / "cache")).collect())) == found  # all from the cache
    assert odd.sparkSession.read.parquet(str(tmp_path / "cache")).count() == stored
    more = odd.union(odd.sparkSession.createDataFrame([(900, "quite new", "en", "a", 7, "k", "r", -1, 5, "q")], SCHEMA))
    assert Counter(map(tuple, tokens.token_counts(more, path, str(tmp_path / "cache")).collect())) == found + Counter([(900, 9, len(encode(["quite new"])[0]))])
    stored += 1  # one miss among hits
    assert odd.sparkSession.read.parquet(str(tmp_path / "cache")).count() == stored
    tokens.token_counts(odd, vocabulary("piece_bpe_32k.model"), str(tmp_path / "cache")).collect()  # another tokenizer
    assert odd.sparkSession.read.parquet(str(tmp_path / "cache")).count() == 2 * stored - 1
    assert tokens.token_counts(empty, path).count() == 0


def test_sum_of_squares_is_close_to_the_bound():
    rng = np.random.default_rng(0)
    lengths = np.concatenate([rng.integers(1, 900, 4000), rng.integers(900, 2049, 500)])
    bins, offsets = packing.sum_of_squares(lengths, 2048)
    filled = np.bincount(bins, weights=lengths)
    assert filled.max() <= 2048 and len(filled) <= 1.01 * lengths.sum() / 2048 + 1
    for b in range(0, len(filled), 50):
        order = np.argsort(offsets[bins == b])
        assert offsets[bins == b][order].tolist() == [0, *np.cumsum(lengths[bins == b][order])[:-1].tolist()]


def test_packing_round_trip(odd, empty):
    path = vocabulary("byte_bpe_50k.json")
    found = packing.pack(odd, path, size=64, group=200).collect()
    encode, wanted = tokens.encoder(path).encode, Counter()
    for r in odd_rows():
        ids = [*encode([r[1] or ""])[0].tolist(), 0]
        first = len(ids) if len(ids) <= 64 else len(ids) % 64 or 64
        edges = [0, *range(first, len(ids) + 1, 64)]
        wanted.update((r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    by = defaultdict(list)
    for r in found:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(n for _, n in places) <= 64
    assert sorted(map(tuple, packing.pack(odd, path, size=64, group=200).collect()), key=repr) == sorted(map(tuple, found), key=repr)
    assert packing.pack(empty, path).count() == 0


# --- language and quality ---


def test_language_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.op3_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h in zip(found.doc_id, found.held_out))
    held = found[found.held_out]
    assert len(held) > 20 and (held.lang == held.lang_pred).mean() >= 0.95 and found.score.between(0, 1).all()


def test_language_odd_cases(odd, empty):
    model = language.train(odd, bits=12)
    found = language.predict(odd, model).select("text", "language.*").collect()
    assert len(found) == len(odd_rows()) and set(model["langs"]) == {"de", "en"}
    for r in found:
        assert (r.lang_pred == "und" and r.score == 0.0) == (not any(map(str.isalpha, r.text or "")))
    none = language.train(empty)
    assert {r.lang_pred for r in language.predict(odd, none).select("language.lang_pred").collect()} == {"und"}
    assert language.predict(empty, model).count() == 0
    # Brute force: counts and scores by plain loops.
    counts = {x: Counter() for x in model["langs"]}
    for r in odd_rows():
        if r[1] is not None and r[2] is not None:
            counts[r[2]].update(language.features(r[1], 12).tolist())
    text = "Der Wald und the mat"
    plain = {x: model["prior"][i] + sum(np.log((c[f] + 0.5) / (sum(c.values()) + 0.5 * 4096)) for f in language.features(text, 12).tolist()) for i, (x, c) in enumerate(counts.items())}
    assert language.score([text], model)[0] == [max(plain, key=plain.get)]


def brute_base(text):
    text = text or ""
    w = words(text)
    seen, marked = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), [0] * len(w)
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            marked[i : i + 5] = [1] * 5
    met, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in met
            met.add(line)
    return len(w), sum(map(len, w)), sum(map(text.count, "#*$%&|<>")), again, sum(marked)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c ", "\n", "#", "é", "\t"]), max_size=60).map(" ".join))
def test_base_counts(text):
    assert quality.base_counts(text) == brute_base(text)


def test_quality_odd_cases(odd, empty):
    found = quality.judge(odd, vocabulary("piece_bpe_32k.model"), into="verdict").collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in odd_rows()) and found[0].quality == "q"
    for r in found:
        v = r.verdict
        assert (v.n_words, v.word_chars, v.n_symbols, v.n_dup_lines, v.n_repeat_words) == brute_base(r.text)
        assert v.base_failed == (v.n_words < 10 or 100 * v.n_repeat_words > 20 * v.n_words) and not (v.base_failed and v.kept)
    assert quality.judge(empty, vocabulary("piece_bpe_32k.model")).count() == 0


def test_bands_reject_what_a_vocabulary_cannot_read():
    prose = "The committee met on Tuesday to discuss the budget, and after a short break most members agreed that the new library should open before winter."
    rng = random.Random(1)
    noise = " ".join("".join(chr(rng.choice([0x13A0, 0x1680, 0xA000, 0x10A0]) + rng.randrange(20)) for _ in range(6)) for _ in range(40))
    piece, is_byte = quality._vocabulary(vocabulary("piece_bpe_32k.model"))
    told = lambda t, b=quality.BANDS: quality.assess(t, None, piece, is_byte, b)
    assert told(prose)[-1] and quality.script("привет мир") == "cyrillic" and quality.script("北京 abc 大学 学生") == "cjk"
    assert not told(noise, quality.BANDS | {"other": {**quality.BANDS["other"], "fallback": 0.5}})[-1]
    assert not told("zq " * 5 + " ".join(f"{w}!!" for w in ["AB", "CD"] * 200))[-1]


@pytest.mark.parametrize(
    "text",
    [
        "הוועדה נפגשה ביום שלישי כדי לדון בתקציב ולאחר הפסקה קצרה רוב החברים הסכימו שהספרייה החדשה צריכה להיפתח לפני החורף והמסמך נשמר",
        "समिति की बैठक मंगलवार को बजट पर चर्चा करने के लिए हुई और थोड़े विराम के बाद अधिकांश सदस्य सहमत हुए कि नया पुस्तकालय सर्दियों से पहले खुलना चाहिए",
        "اجتمعت اللجنة يوم الثلاثاء لمناقشة الميزانية وبعد استراحة قصيرة اتفق معظم الأعضاء على أن تفتح المكتبة الجديدة قبل حلول الشتاء",
    ],
)
def test_one_latin_word_does_not_make_a_text_latin(text):
    piece, is_byte = quality._vocabulary(vocabulary("piece_bpe_32k.model"))
    told = [quality.assess(t, None, piece, is_byte, quality.BANDS) for t in (text, text + " PDF")]
    assert [x[6] for x in told] == ["other", "other"] and [x[-1] for x in told] == [True, True]


def test_calibrated_bands_reject_labelled_junk(spark):
    sf = "/root/testdata/sf0.01"
    judged = queries.op4_quality(spark, sf).where("NOT base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in judged}
    assert n[0, False] > 0.7 * (n[0, False] + n.get((0, True), 0)), n
    assert n.get((1, False), 0) < 0.03 * n[1, True], n


def test_bands_of_few_labels_fall_back(spark, odd, empty):
    path = vocabulary("piece_bpe_32k.model")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(70)] + [(None, 1, None)], "doc_id long, quality int, toxic int")
    assert quality.calibrate(odd, labels, path) == {} == quality.calibrate(empty, labels, path) == quality.calibrate(odd, labels.limit(0), path)
    bands = quality.calibrate(odd, labels, path, least=3)
    assert "latin" in bands and set(bands) <= {"latin", "other", "en", "de"}
    assert quality.judge(odd, path, bands, lang_col="lang").count() == len(odd_rows())


def test_bands_are_measured_on_all_labelled_documents(spark):
    """More than 4,000 good documents: every one counts, as numpy's quantiles and least squares over all of them say."""
    rng = np.random.default_rng(3)
    rows_ = [("en" if i % 5 else "de", "latin", int(n), float(c), float(f), float(0.4 * np.log2(n) + e)) for i, (n, c, f, e) in enumerate(zip(rng.integers(9, 4000, 9000), rng.normal(4, 1, 9000), rng.choice([0.0, 0.0, 0.1, 0.3], 9000), rng.normal(0, 1, 9000), strict=True))]
    good = spark.createDataFrame(rows_, "lang string, script string, n_tokens long, chars_per_token double, fallback_share double, token_entropy double")
    bands = quality.measured_bands(good, 100)
    assert set(bands) == {"en", "de", "latin"}
    for key, band in bands.items():
        n, chars, fallback, entropy = (np.array([r[i] for r in rows_ if key in r[:2]], float) for i in range(2, 6))
        low, high = np.quantile(chars, [0.002, 0.998])
        assert np.allclose(band["chars"], (low - 0.1 * (high - low), high + 0.1 * (high - low)), rtol=1e-12)
        assert np.isclose(band["fallback"], 1.1 * np.quantile(fallback, 0.998) + 0.01)
        curve = np.polyfit(np.log2(n), entropy, 2)
        t = (np.log2(n) - band["centre"]) / band["scale"]
        assert np.allclose(np.polyval(band["curve"], t), np.polyval(curve, np.log2(n)), atol=1e-7)
        assert np.isclose(band["margin"], -np.quantile(entropy - np.polyval(curve, np.log2(n)), 0.002), atol=1e-7)


def test_labelled_documents_beyond_four_thousand_move_the_bands(spark):
    """Good documents of a kind that a sample of 4,000 may miss: the band holds what it holds of all."""
    plain = "the cat sat on a mat and saw 12 birds fly over old roofs at dawn"
    texts = [(i, f"{plain} {i} {i * 7919}", "en") for i in range(6000)] + [(10_000 + i, " ".join(f"{i} {j} q{j * j}zx{i * j}" for j in range(9)), "xx") for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    bands = quality.calibrate(docs, labels, vocabulary("piece_bpe_32k.model"), least=90)
    assert "xx" in bands and "en" in bands  # all 90 are needed; two thirds of them are fewer
    path = vocabulary("piece_bpe_32k.model")
    told = quality.judge_by_labels(docs, labels, path, least=90, into="told")
    assert rows(told.select("doc_id", "told.*").toPandas()) == rows(quality.judge(docs, path, bands, lang_col="lang", into="told").select("doc_id", "told.*").toPandas())


def test_letters_vote_for_the_script():
    assert quality.script("naïve café 12") == "latin" and quality.script("12 — 3") == quality.script("") == quality.script("12") == "other"
    assert quality.script("αβγ abcd") == "latin" and quality.script("αβγδε abc") == "greek" and quality.script("שלום abc") == "other"


# --- passages ---


def test_anchors_that_dont_recur_are_not_counted(spark, monkeypatch):
    """A filter far smaller than the corpus, as 32 MB are for 6 GB: only windows of recurring anchors go on."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(400)) for _ in range(3000)]
    texts += [texts[5][:2000], texts[7]]
    monkeypatch.setattr(bloom, "MOST_BITS", bloom.BLOCK * 8)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bitmaps, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: bitmaps.append(value) or broadcast(self, value))
    told = {r.doc_id: r.passages.n_removed for r in passages.remove_repeated_passages(docs).collect()}
    assert {i for i, n in told.items() if n} == {5, 7, 3000, 3001} and told[7] == told[3001] == 400
    filled = int(np.unpackbits(bitmaps[0]).sum())
    assert filled < 4 * 80, filled  # the anchors of some 600 words; all anchors together are about 90,000


# --- near-duplicates ---


def brute_fingerprint(text):
    import xxhash

    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(points, k=3):
    parent = list(range(len(points)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if bin(points[i] ^ points[j]).count("1") <= k:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


def clustered(n, seed):
    rng, out = random.Random(seed), []
    for _ in range(n):
        centre = rng.getrandbits(64)
        out.append(centre)
        for _ in range(rng.randrange(6)):
            centre ^= 1 << rng.randrange(64)
            out.append(centre)
    return out


def test_fingerprints_and_classes(odd, empty):
    found = simhash.near_duplicates(odd, shard=4).collect()
    assert Counter((r.id, r.fp % (1 << 64)) for r in found) == Counter((r[0], brute_fingerprint(r[1])) for r in odd_rows())
    mine = odd_rows()
    roots = brute_classes([brute_fingerprint(r[1]) for r in mine])
    least = defaultdict(list)
    for r, root in zip(mine, roots):
        least[root] += [r[0]] if r[0] is not None else []
    assert Counter((r.id, r.component_id) for r in found) == Counter((r[0], min(least[root], default=None)) for r, root in zip(mine, roots))
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_stays(odd, empty):
    mine = odd_rows()
    roots = brute_classes([brute_fingerprint(r[1]) for r in mine])
    kept = simhash.one_of_each(odd, shard=4).collect()
    assert len(kept) == len(set(roots)) and kept[0].size == 7
    assert simhash.one_of_each(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_tree_shards_lose_no_link(seed):
    points = np.unique(np.array(clustered(150, seed), np.uint64))
    nodes = simhash.build_tree(points[::3], 12, 3)
    leaf, idx, home = simhash.route(points, nodes, 3)
    assert np.bincount(idx[home], minlength=len(points)).tolist() == [1] * len(points)
    parent = {int(p): int(p) for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in np.unique(leaf):
        here = leaf == x
        for a, b in zip(*simhash.link(points[idx[here & home]], points[idx[here & ~home]], 3)):
            a, b = find(int(a)), find(int(b))
            parent[max(a, b)] = min(a, b)
    roots = brute_classes(points.tolist())
    classes = defaultdict(set)
    for p, r in zip(points.tolist(), roots):
        classes[r].add(find(p))
    assert all(len(c) == 1 for c in classes.values()) and len({next(iter(c)) for c in classes.values()}) == len(classes)


def test_deepened_trees_lose_no_link(spark):
    """A sample too small for the table: leaves are deepened level by level, and no link is lost."""
    mine = sorted(set(clustered(300, 21)))
    fps = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in mine], "fp long").repartition(3)
    nodes = simhash.build_tree(np.array(mine[:40], np.uint64), 100, 3)
    deeper = simhash.graft(nodes, {x: simhash.build_tree(np.array(mine[::2], np.uint64), 6, 3) for x in range(0, simhash.n_leaves(nodes), 2)})
    leaf, idx, home = simhash.route(np.array(mine, np.uint64), deeper, 3)
    assert np.bincount(idx[home], minlength=len(mine)).tolist() == [1] * len(mine) and simhash.n_leaves(deeper) > simhash.n_leaves(nodes)
    links = simhash.fingerprint_links(fps, 3, Scratch(spark, "test"), len(mine), shard=8, sample=40).collect()
    parent = {p: p for p in mine}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        a, b = find(r.a % (1 << 64)), find(r.b % (1 << 64))
        parent[max(a, b)] = min(a, b)
    roots = [mine[i] for i in brute_classes(mine)]
    assert len(links) and [find(p) for p in mine] == [min(q for q, r2 in zip(mine, roots) if r2 == r) for r in roots]


def test_local_search_by_tree(monkeypatch):
    points = np.unique(np.array(clustered(400, 9), np.uint64))
    whole = simhash.link(points, points[:0], 3)
    monkeypatch.setattr(simhash, "PAIRS", 5000)
    assert set(zip(*map(np.ndarray.tolist, simhash.link(points, points[:0], 3)))) == set(zip(*map(np.ndarray.tolist, whole)))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(300, 500)] + [(1, 1), (5, 3), (3, 5)]
    found = components.components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    got = {r.node: r.label for r in found.collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in range(300, 500)) and got[5] == got[3] == 3 and 1 not in got
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0


# --- lines and passages ---


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=40), min_size=1, max_size=6))
def test_no_repeat_is_missed(batches):
    bits, once, twice = 1 << 19, np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    for batch in batches:
        h, n = np.unique((np.array(batch, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), return_counts=True)
        again = (n > 1) | bloom.contains(once, h, bits)
        bloom._insert(twice, h[again], bits)
        bloom._insert(once, h, bits)
    repeated = [x for x, n in Counter(v for b in batches for v in b).items() if n > 1]
    assert bloom.contains(twice, (np.array(repeated, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), bits).all()


def brute_lines(mine, least):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\v\f\r"))
    split = [(t or "").split("\n") for t in mine]
    n = Counter(k for x in split for k in {key(line) for line in x} if k)
    return [(len(x), [line for line in x if n[key(line)] < least]) for x in split]


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_lines(odd, empty, most):
    found = lines.drop_repeated_lines(odd, min_docs=3, broadcast_lines=most).collect()
    wanted = Counter((r[0], r[1] is None or "\n".join(kept), n, n - len(kept)) for r, (n, kept) in zip(odd_rows(), brute_lines([r[1] for r in odd_rows()], 3)))
    assert Counter((r.doc_id, r.text is None or r.lines.text, r.lines.n_lines, r.lines.n_dropped) for r in found) == wanted
    assert sum(r.lines.n_dropped for r in found) > 0 and found[0].row == "r"
    assert lines.drop_repeated_lines(empty).count() == 0


def test_first_line_stays(spark):
    docs = spark.createDataFrame([(3, "x\nsame"), (1, "Same \nsame\ny"), (2, "SAME")], "doc_id long, text string")
    got = {r.doc_id: r.lines.text for r in lines.drop_repeated_lines(docs, min_docs=3, keep_first=True).collect()}
    assert got == {1: "Same \ny", 2: "", 3: "x"}


def brute_passages(mine, n):
    split = [words(t) for t in mine]
    seen = Counter(tuple(w[i : i + n]) for w in split for i in range(len(w) - n + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone |= set(range(i, i + n))
        out.append((" ".join(x for i, x in enumerate(w) if i not in gone), len(w), len(gone)))
    return out


@pytest.mark.parametrize("n,frequent", [(5, 1000), (12, 2), (35, 1)])
def test_passages(odd, empty, n, frequent):
    found = passages.remove_repeated_passages(odd, n=n, frequent=frequent).collect()
    wanted = Counter((r[0], *b) for r, b in zip(odd_rows(), brute_passages([r[1] for r in odd_rows()], n)))
    assert Counter((r.doc_id, r.passages.text, r.passages.n_words, r.passages.n_removed) for r in found) == wanted
    assert sum(r.passages.n_removed for r in found) > 0 and found[0].kept == "k"
    assert passages.remove_repeated_passages(empty, n=n).count() == 0


def test_anchors_are_leftmost_minima():
    rng = np.random.default_rng(2)
    g = rng.integers(0, 6, 300).astype(np.uint64)
    for w in (1, 2, 5, 8, 13):
        assert passages.leftmost_least(g, w).tolist() == [i + int(g[i : i + w].argmin()) for i in range(len(g) - w + 1)]


# --- search ---


def test_search_equals_sql_on_odd_rows(odd, empty, tmp_path):
    odd.select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    import duckdb

    sql = queries.OP6_SQL.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'")
    theirs = duckdb.connect().sql(sql).df()
    docs = odd.sparkSession.read.parquet(str(tmp_path / "documents.parquet")).repartition(5)
    ours = search.top_k(docs, docs.where("doc_id % 50 = 0"), block_terms=20).select("query_id", F.col("id").alias("doc_id"), F.round("score", 4).alias("score"), "rank").toPandas()
    assert rows(ours.astype({"rank": "int64"})) == rows(theirs.astype({"rank": "int64"})) and ours.doc_id.isna().any() == theirs.doc_id.isna().any()
    assert search.top_k(empty, empty).count() == 0 and search.top_k(docs, empty).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    same(queries.QUERIES[name](spark, sf), sf, queries.ORACLES[name])


def test_pruning_keeps_the_best(monkeypatch):
    rng = np.random.default_rng(4)
    batch = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 60) % 500)) for i in range(600)]
    import pyarrow as pa

    monkeypatch.setattr(search, "LONG", 20)
    shard = next(search._index(60.0)([pa.RecordBatch.from_arrays([pa.array([b[0] for b in batch]), pa.array([b[1] for b in batch])], ["id", "text"])])).to_pylist()[0]
    index, counted = search.Shard(shard, 60.0), [Counter(words(t)) for _, t in batch]
    assert len(index.maxima) > 5
    df = Counter(w for c in counted for w in c)
    long = np.flatnonzero((np.diff(index.starts) > 20) & (index.place < 0))[:1]  # a query of one long list only
    assert len(long) and len(index.top(long, np.ones(1), 10, 0.0, index.bounds([(long, np.ones(1))])[0])[0]) == 10
    for q in range(0, 600, 40):
        h = search.term_counts(batch[q][1])[0]
        at = np.searchsorted(index.terms, h)
        n = np.diff(index.starts)[at]
        idf = np.log(1 + (600 - n + 0.5) / (n + 0.5))
        whole = [sum(np.log(1 + (600 - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2) for w in counted[q] if w in c) for c in counted]  # all are 60 words long
        best = sorted(((-round(s, 6), i) for i, s in enumerate(whole) if s > 0))[:10]
        for floor in (0.0, -best[4][0], -best[-1][0] - 1e-6):
            docs, score = index.top(at, idf, 10, floor, index.bounds([(at, idf)])[0])
            wanted = [(pytest.approx(s), i) for s, i in best if -s >= floor]
            assert sorted(zip((-score).tolist(), index.ids[docs].tolist())) == wanted


def test_ranges_below_the_floor_are_skipped(monkeypatch):
    """Documents of two vocabularies are two ranges; a query of one leaves the other alone and misses nothing."""
    rng = np.random.default_rng(5)
    batch = [(i, " ".join(f"{'ab'[i % 2]}{int(x)}" for x in rng.zipf(1.3, 60) % 300) + f" both{int(rng.integers(3))}") for i in range(400)]
    import pyarrow as pa

    monkeypatch.setattr(search, "RANGE_DOCS", 1)
    shard = next(search._index(61.0)([pa.RecordBatch.from_arrays([pa.array([b[0] for b in batch]), pa.array([b[1] for b in batch])], ["id", "text"])])).to_pylist()[0]
    index = search.Shard(shard, 61.0)
    kinds = [set((index.ids[a:b] % 2).tolist()) for a, b in zip(index.ranges, index.ranges[1:], strict=False)]
    assert {0} in kinds and {1} in kinds and {0, 1} not in kinds
    idf = np.log(1 + (400 - np.diff(index.starts) + 0.5) / (np.diff(index.starts) + 0.5))
    asked = [(at, idf[at]) for at in (np.searchsorted(index.terms, search.term_counts(t)[0]) for _, t in batch[:40])]
    whole = [index.top(*q, 10, 0.0, made) for q, made in zip(asked, index.bounds(asked), strict=True)]
    floors = np.array([score.min() for _, score in whole])
    skipped = 0
    for i, (q, (sums, bound), (docs, score)) in enumerate(zip(asked, index.bounds(asked, floors), whole, strict=True)):
        other = index.ids % 2 != i % 2
        assert (bound[other] < floors[i]).all()
        skipped += np.allclose(bound[other], sums[other], rtol=1e-3)  # without the words of both
        found = index.top(*q, 10, floors[i], (sums, bound))
        assert sorted(zip(found[0].tolist(), found[1].tolist())) == sorted(zip(docs.tolist(), score.tolist()))
    assert skipped > 30


def test_ties_survive_later_rounds(spark):
    """Equal copies over more shards than the first round takes: the smallest ids win, however the score is rounded."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(12)) + f" own{g}" for g in range(12)]
    mine = [(40 * g + i, t) for g, t in enumerate(texts) for i in range(40)]
    docs = spark.createDataFrame(sorted(mine, key=lambda r: -(r[0] % 40)), "doc_id long, text string").repartitionByRange(20, F.desc(F.col("doc_id") % 40))
    found = search.top_k(docs, docs.where("doc_id % 40 = 0"), k=10)
    got = defaultdict(list)
    for r in found.orderBy("rank").collect():
        got[r.query_id].append(r.id)
    assert got == {40 * g: [40 * g + i for i in range(10)] for g in range(12)}


# --- personal data ---


def test_surrogates(spark):
    text = 'Mail Anna.Q@corp.example.org or ANNA.q@corp.example.org, call +1 (743) 555-3824 or +1 743-555-3824; card 4111 1111 1111 1111 or 4111111111111111, ip 10.0.0.1, token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", Frau Schmidt, Maria Lopez, Сергей Иванов, 123-45-6789'
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Maria Lopez in 1999 2000 2001, 1.2.3.4.5")], "doc_id long, text string")
    got = {r.doc_id: r.pii for r in pii.replace_entities(docs, "key").collect()}
    assert got[2].text is None and got[3].text == "" and got[2].n_entities == 0 and got[1].n_entities == 12
    for secret in ("corp", "743", "4111", "10.0.0.1", "24be6443", "Schmidt", "Lopez", "Иванов", "123-45"):
        assert secret not in got[1].text
    mails = re.findall(r"\S+@\S+?(?=[ ,])", got[1].text)
    assert len(mails) == 2 and len(set(mails)) == 1  # one address in two spellings
    phones = re.findall(r"\+1 [()\d -]{12,14}", got[1].text)
    assert len({re.sub(r"\D", "", p) for p in phones}) == 1 and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", phones[0])
    lopez = re.search(r"(\S+ \S+) in 1999 2000 2001, 1\.2\.3\.4\.5$", got[4].text)[1]
    assert lopez in got[1].text and lopez.split()[0] in pii.GIVEN["f", "latin"]  # coreference, gender, script
    assert re.search(r"Frau \S+", got[1].text) and re.search("|".join(pii.GIVEN["m", "cyrillic"]), got[1].text)
    again = {r.doc_id: r.pii for r in pii.replace_entities(docs, "key").collect()}
    assert again == got and {r.doc_id: r.pii for r in pii.replace_entities(docs, "other").collect()}[1].text != got[1].text


def test_numbers_are_permuted(spark):
    numbers = spark.range(0, 1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    mapped = [r.m for r in numbers.select(pii.feistel_digits(F.col("d"), F.lit("k")).alias("m")).collect()]
    assert sorted(mapped) == [f"{i:03d}" for i in range(1000)]
    ips = spark.range(0, 3000).select(F.concat_ws(".", F.lit("10"), F.lit("0"), F.floor(F.col("id") / 256).cast("string"), (F.col("id") % 256).cast("string")).alias("d"))
    out = {r.m for r in ips.select(pii.feistel_ip(F.col("d"), F.lit("k")).alias("m")).collect()}
    assert len(out) == 3000 and all(re.fullmatch(rf"(?:{pii.OCTET}\.){{3}}{pii.OCTET}", x) for x in out)


def test_shared_surrogates_are_moved(spark, monkeypatch):
    """With surrogates of few values entities collide; the check sets them apart."""
    monkeypatch.setattr(pii, "surrogate", lambda m, key, attempt: F.concat(F.lit("s"), F.pmod(F.hash(F.concat(pii.normal(m, pii.kind(m)), attempt.cast("string"))), F.lit(40)).cast("string")))
    found = spark.createDataFrame([(f"u{i}@x.example.org",) for i in range(12)], "entity string")
    moved = pii.moved_entities(found, "k", Scratch(spark, "test"), tries=60)
    m = F.col("entity")
    written = [r.s for r in found.select(pii.surrogate(m, "k", pii._attempt(m, moved)).alias("s")).collect()]
    assert len(set(written)) == 12


def test_whole_names_stay_in_their_script(spark):
    names = {"Сергей Иванов": r"[А-Яа-яё]+ [А-Яа-я]+ов", "Анна Иванова": r"[А-Яа-яё]+ [А-Яа-я]+ова", "Dr. Петрова": r"Dr\. [А-Яа-я]+ова", "Νίκος Παπαδόπουλος": r"[Ͱ-Ͽ]+ [Ͱ-Ͽ]+", "Maria Lopez": r"[A-Z][a-z]+ [A-Z][a-z]+"}
    docs = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    found = {r.text: r.pii.text for r in pii.replace_entities(docs, "k").collect()}
    assert all(re.fullmatch(p, found[n]) and found[n].split()[-1] != n.split()[-1] for n, p in names.items())


def test_number_clashes(spark):
    """Spellings of one number share a surrogate; numbers apart stay apart, also on a later attempt."""
    groups = [["1.2.3.4", "1.2.3.04"], ["1.2.3.5"], ["+1 (743) 555-3824", "+17435553824", "+1 743-555-3824"], ["(743) 555-3824", "743-555-3824"], ["+49 30 1234567", "+49301234567"], ["+43 1234 5678"], ["(431) 234-5678"]]
    groups += [["GB29 NWBK 6016 1331 9268 19", "GB29NWBK60161331926819"], ["GB29 NWBL 6016 1331 9268 19"], ["4111 1111 1111 1111", "4111111111111111"], ["123-45-6789"]]
    found = spark.createDataFrame([(x,) for g in groups for x in g], "entity string")
    assert pii.moved_entities(found, "k", Scratch(spark, "test")) == {}
    m = F.col("entity")
    plain = lambda attempt: {r.entity: r.p for r in found.select(m, pii.normal(pii.surrogate(m, "k", F.lit(attempt)), pii.kind(m)).alias("p")).collect()}
    told, later = plain(0), plain(1)
    assert all(len({told[x] for x in g}) == 1 for g in groups) and len(set(told.values())) == len(groups)
    assert all(told[x] != later[x] for x in told) and told["+49301234567"].startswith("phone:+49") and "NWBK" not in told["GB29NWBK60161331926819"]
    docs = spark.createDataFrame([(1, "from 1.2.3.4 and 1.2.3.04, GB29 NWBK 6016 1331 9268 19.")], "doc_id long, text string")
    done = pii.replace_entities(docs, "k").first().pii
    assert done.counts.iban == 1 and done.counts.ip == 2 and len(set(re.findall(r"[\d.]+\d", done.text.split(" GB")[0]))) == 1


def luhn(n):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(n))) % 10 == 0


def test_check_digits_stay_right(spark):
    rng, cards = random.Random(7), []
    for k in range(40):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14 + k % 2))
        cards.append(next(body + d for d in "0123456789" if luhn(body + d)))
    ibans = ["DE89370400440532013000", "GB29NWBK60161331926819", "FR1420041010050500013M02606"]
    found = spark.createDataFrame([(x,) for x in [*cards, *ibans, "4111111111111112"]], "entity string")
    told = {r.entity: r.w for r in found.select("entity", pii.surrogate(F.col("entity"), "k", F.lit(0)).alias("w")).collect()}
    assert all(luhn(told[c]) and told[c] != c and len(told[c]) == len(c) for c in cards) and len({told[c] for c in cards}) == len(set(cards))
    assert all(int("".join(str(int(c, 36)) for c in told[i][4:] + told[i][:4])) % 97 == 1 and told[i] != i and told[i][:2] == i[:2] for i in ibans)
    docs = spark.createDataFrame([(1, f"card {cards[0]} IBAN {ibans[1]}.")], "doc_id long, text string")
    assert pii.replace_entities(docs, "k").first().pii.text == f"card {told[cards[0]]} IBAN {told[ibans[1]]}."


def test_names_after_cues(spark):
    docs = spark.createDataFrame([(1, "My name is Ottilie Kranz and Contact: Ottilie Kranz. The Big House"), (2, "Name: Зоя Петренко, deadbeefdeadbeefdeadbeefdeadbeef")], "doc_id long, text string")
    got = {r.doc_id: r.pii for r in pii.replace_entities(docs, "k").collect()}
    names = re.findall(r"(?:is|Contact:) (\S+ [^ .]+)", got[1].text)
    assert got[1].counts.name == 2 and len(set(names)) == 1 and names[0] != "Ottilie Kranz" and got[1].text.endswith("The Big House")
    assert got[2].n_entities == 2 and re.match(r"Name: [А-Яа-яё]+ [А-Яа-я]+, [0-9a-f]{32}$", got[2].text) and "Зоя" not in got[2].text


def test_columns_of_any_name(spark):
    names = ["doc_id", "text", "lang", "source", "mentions", "between", "pii", "lines", "quality", "language", "passages", "mix", "kept", "row", "told", "size", "Lines"]
    docs = spark.createDataFrame([(i, "a b c " * 20, "en", "s", *["x"] * 13) for i in range(3)], ", ".join(f"{n if n != 'Lines' else 'lines2'} {'long' if n == 'doc_id' else 'string'}" for n in names))
    path = vocabulary("piece_bpe_32k.model")
    made = {"pii": pii.replace_entities(docs, "k"), "lines": lines.drop_repeated_lines(docs, min_docs=2), "quality": quality.judge(docs, path), "language": language.predict(docs, language.train(docs)), "passages": passages.remove_repeated_passages(docs), "mix": mixing.mix(docs)}
    made["lines "] = lines.drop_repeated_lines(docs, min_docs=2, broadcast_lines=0)
    for name, found in made.items():
        name = name.strip()
        assert sorted(found.columns) == sorted(docs.columns) and found.schema[name].dataType.typeName() == "struct"
        row = found.select("*", f"{name}.*").first()
        assert all(row[c] == "x" for c in ("told", "mentions", "between", "row") if c != name)


def test_surrogates_odd_cases(odd, empty):
    found = pii.replace_entities(odd, "k").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((r.doc_id, r.pii.text) for r in found) == Counter((r[0], r[1]) for r in odd_rows())
    assert pii.replace_entities(empty, "k").count() == 0


# --- mixing ---


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "b", "B", "é", "z", None]), st.integers(0, 1000), min_size=1))
def test_targets(spark, sizes):
    found = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: pytest.approx(r.target) for r in found} == brute_targets(sizes)


def check_mix(found):
    by = defaultdict(list)
    for r in found:
        by[r.source].append(r.mix)
    wanted = brute_targets({s: sum(m.size for m in ms) for s, ms in by.items()})
    for s, ms in by.items():
        assert {m.source_size for m in ms} == {sum(m.size for m in ms)} and ms[0].target == pytest.approx(wanted[s])
        assert all(m.taken == m.size * m.copies and 0 <= m.copies <= 3 for m in ms)
        assert abs(sum(m.taken for m in ms) - ms[0].target) <= max(m.size for m in ms) / 2 + 1e-6
        whole = int(ms[0].target // max(1, ms[0].source_size))
        assert all(whole <= m.copies <= whole + 1 for m in ms if m.size)


def test_mix(odd, empty, spark, sf):
    check_mix(odd_mix := mixing.mix(odd).collect())
    assert odd_mix[0]["size"] == 7 and len(odd_mix) == len(odd_rows())
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 150")
    check_mix(found := mixing.mix(docs).collect())
    key = lambda rs: sorted((r.doc_id, r.mix.copies) for r in rs)
    assert key(mixing.mix(docs.repartition(7)).collect()) == key(found)
    repeated = mixing.mixed(docs)
    assert repeated.columns == docs.columns and repeated.count() == sum(r.mix.copies for r in found)
    assert mixing.mix(empty).count() == 0


def test_unequal_odds(spark):
    """A document's share of draws over many seeds follows its importance."""
    docs = spark.createDataFrame([(i, "w " * 10, "s", 3.0 if i < 100 else 1.0) for i in range(400)], "doc_id long, text string, source string, v double")
    docs = docs.unionByName(spark.createDataFrame([(1000 + i, "w " * 30, "t", 1.0) for i in range(400)], "doc_id long, text string, source string, v double"))
    found = [r for r in mixing.mix(docs, importance="v").collect() if r.source == "s"]
    important, plain = (sum(r.mix.copies for r in found if (r.v > 1) == x) / n for x, n in ((True, 100), (False, 300)))
    assert important > 1.5 * plain
