"""Exact token ids of public tokenizers, and token counts through a digest cache.

``Encoder`` gives what the library for a file gives: tokenizers for ``.json``, sentencepiece for ``.model``, tiktoken
for ``.tiktoken``.  A byte-level BPE ``.json`` without normaliser is run by tiktoken over the same vocabulary, several
times as fast; texts that hold one of its added tokens go to the tokenizers library itself, and the tests compare both
on arbitrary text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import Scratch

#: The pre-tokenisation pattern of the byte-level pre-tokenizer, and without its look-ahead, which only
#: matters where two white-space characters meet.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
TWO_SPACES = re.compile(r"\s\s")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Token ids of whole texts; ``encode`` takes a list of strings and gives a list of id arrays."""

    def __init__(self, path: str):
        self.path = path
        with open(path, "rb") as file:
            raw = file.read()
        #: Tells vocabularies apart in the cache.
        self.version = hashlib.sha256(raw).hexdigest()
        if path.endswith(".json"):
            self.encode = self._json(raw)
        elif path.endswith(".model"):
            import sentencepiece

            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [np.asarray(x, np.uint32) for x in piece.encode(list(texts), num_threads=1)]
        elif path.endswith(".tiktoken"):
            bpe = self._bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())})
            self.encode = lambda texts: [bpe(x) for x in texts]
        else:
            raise ValueError(f"no library is known for {path}")

    @staticmethod
    def _bpe(ranks: dict[bytes, int]):
        import tiktoken

        full = tiktoken.Encoding("full", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        short = tiktoken.Encoding("short", pat_str=SHORT_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda x: np.asarray((full if TWO_SPACES.search(x) else short)(x), np.uint32)

    def _json(self, raw: bytes):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(raw.decode("utf-8"))
        library.no_truncation()
        library.no_padding()
        exact = lambda x: np.asarray(library.encode(x, add_special_tokens=False).ids, np.uint32)
        told = json.loads(raw)
        model, before = told["model"], told.get("pre_tokenizer") or {}
        plain = model["type"] == "BPE" and not told.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return lambda texts: [exact(x) for x in texts]
        letters, added = _byte_letters(), {x["content"] for x in told["added_tokens"]}
        bpe = self._bpe({bytes(letters[c] for c in word): i for word, i in model["vocab"].items() if word not in added})
        return lambda texts: [exact(x) if any(a in x for a in added) else bpe(x) for x in texts]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """Each Python worker reads a vocabulary once."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"


def token_counts(docs: DataFrame, vocabulary: str, cache: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for every row, through a cache of counts.

    A text's key is the SHA-256 digest of its normalised content together with the digest of the tokenizer's file.
    Byte-level vocabularies tell all bytes apart, so normalising goes no further than null becoming empty; anything
    more could change a count.  Keys are joined to the counts stored in the Parquet folder ``cache`` (in the cluster's
    shared folder if not given); each distinct text that misses is encoded once and appended.

    Texts travel to the encoder compressed and at most once per task and digest, so a group of copies that holds a
    third of all rows is a handful of rows there.  Null text counts as empty (0 tokens); null ids and repeated rows
    each give their row; an empty table gives none.  Rows are joined on digests only, so a hot digest is a skewed
    equi-join that adaptive execution splits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "tokens")
    cache = cache or f"{scratch.root}/cache"
    version = encoder(vocabulary).version
    content = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), F.octet_length(content).cast("long").alias("n_bytes"), F.unhex(F.sha2(content, 256)).alias("digest"))
    keys = scratch.table(keyed, "keys")
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(cache)
    stored = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version).select("digest") if stored else None

    texts = docs.select(content.alias("text"))
    if known is None:
        texts = texts.mapInArrow(_packed_once(), "digest binary, packed binary")
    else:
        # Only digests are joined to the cache; texts that miss are told by a bounded filter before they move.
        missing = scratch.table(keys.select("digest").distinct().join(known, "digest", "left_anti"), "missing")
        bits = bloom.filter_bits(missing.count())
        twice = lambda batch: np.repeat(_heads(batch.column(0).to_pylist()), 2)
        wanted = spark.sparkContext.broadcast(bloom.repeats(missing, twice, bits))
        texts = texts.mapInArrow(_packed_once(wanted, bits), "digest binary, packed binary").join(missing, "digest", "left_semi")
    made = texts.repartition("digest").mapInArrow(_count_misses(vocabulary), CACHE_SCHEMA)
    made.write.mode("append").parquet(cache)
    if known is not None:
        wanted.destroy()

    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == version).groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    # Written first: the join then stands on plain exchanges alone, of which a hot digest's can be split.
    return keys.join(scratch.table(counts, "counts"), "digest").select("id", "n_bytes", "n_tokens")


#: Digests remembered in a task at once; a digest met again after that only costs a repeated row.
REMEMBERED = 500_000


def _heads(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)


def _packed_once(wanted=None, bits: int = 0):
    """Compressed texts by digest, once a task; with a broadcast filter ``wanted`` only those that pass it."""

    def run(batches):
        import zstandard

        squeeze, seen = zstandard.ZstdCompressor(level=3).compress, set()
        for batch in batches:
            new: dict[bytes, bytes] = {}
            for text in batch.column(0):
                raw = text.as_py().encode("utf-8")
                digest = hashlib.sha256(raw).digest()
                if digest not in seen:
                    seen.add(digest)
                    new[digest] = raw
            if wanted is not None and new:
                passed = bloom.contains(wanted.value, _heads(list(new)), bits)
                new = {d: raw for (d, raw), yes in zip(new.items(), passed.tolist(), strict=True) if yes}
            if len(seen) > REMEMBERED:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array([squeeze(raw) for raw in new.values()], pa.binary())], ["digest", "packed"])

    return run


def _count_misses(vocabulary: str):
    def run(batches):
        import zstandard

        expand, made, seen = zstandard.ZstdDecompressor().decompress, encoder(vocabulary), set()
        for batch in batches:
            digests, counts = [], []
            for digest, packed in zip(batch.column(0), batch.column(1), strict=True):
                if (key := digest.as_py()) not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()  # counting a text again gives an equal row
                    seen.add(key)
                    digests.append(key)
                    counts.append(len(made.encode([expand(packed.as_py()).decode("utf-8")])[0]))
            yield pa.RecordBatch.from_arrays([pa.array([made.version] * len(digests), pa.string()), pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], ["tokenizer", "digest", "n_tokens"])

    return run
