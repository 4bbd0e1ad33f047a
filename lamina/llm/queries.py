"""The registered queries of the training-data operators: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, labels


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    docs = documents(spark, sf_dir).select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken", "mix.copies")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an empty cache, so that every run does the whole work; ``token_counts`` takes a cache that lasts."""
    from .tokens import token_counts

    counts = token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import held_out, predict, train

    docs = documents(spark, sf_dir).withColumn("held_out", held_out(F.col("doc_id")))
    model = train(docs.where(~F.col("held_out")))
    return predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "language.lang_pred", "language.score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands by language or script, measured on all documents that ``labels`` calls good."""
    from .quality import judge_by_labels

    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return judge_by_labels(docs, labels(spark, sf_dir), vocabulary("piece_bpe_32k.model")).select("doc_id", "quality.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of the documents whose id is divisible by 50, against all documents."""
    from .search import top_k

    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = top_k(docs, docs.where(F.col("doc_id") % 50 == 0), k=10)
    return found.select("query_id", F.col("id").alias("doc_id"), F.round("score", 4).alias("score"), F.col("rank").cast("int").alias("rank"))


OP6_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
t AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM w) GROUP BY r, term),
n AS (SELECT count(*) AS docs, avg(len(words)) AS mean FROM w),
df AS (SELECT term, count(*) AS df FROM t GROUP BY term),
q AS (SELECT DISTINCT w.doc_id AS query_id, term FROM t JOIN w ON t.r = w.r WHERE w.doc_id % 50 = 0),
s AS (SELECT q.query_id, t.r, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean))), 6) AS score
      FROM q JOIN df ON q.term = df.term JOIN t ON q.term = t.term JOIN w ON t.r = w.r, n GROUP BY q.query_id, t.r),
k AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s JOIN w ON s.r = w.r)
SELECT query_id, doc_id, round(score, 4) AS score, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 10
"""


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import drop_repeated_lines

    cleaned = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2(F.coalesce("lines.text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
gone AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, gone.key IS NOT NULL AS dropped FROM k LEFT JOIN gone ON k.key = gone.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import replace_entities

    key = spark.conf.get("lamina.pii.key", "a key for trials")  # a real one is set in the session
    replaced = replace_entities(documents(spark, sf_dir).select("doc_id", "text"), key=key)
    return replaced.select("doc_id", "pii.text", "pii.n_entities", *[F.col(f"pii.counts.{k}").alias(f"n_{k}") for k in ("email", "secret", "ip", "iban", "phone", "ssn", "card", "name")])


def op9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .passages import remove_repeated_passages

    cut = remove_repeated_passages(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "passages.n_words", "passages.n_removed", F.sha2("passages.text", 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, unnest(generate_series(1, len(w) - 34)) AS i FROM d),
k AS (SELECT s.r, i, hash(list_slice(w, i, i + 34)) AS h, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS m FROM s JOIN d ON s.r = d.r),
again AS (SELECT h, m FROM k GROUP BY h, m HAVING count(*) > 1),
gone AS (SELECT DISTINCT k.r, i + j AS p FROM k JOIN again ON k.h = again.h AND k.m = again.m, generate_series(0, 34) AS g(j)),
x AS (SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT x.r, string_agg(word, ' ' ORDER BY x.p) AS words, count(*) AS n FROM x LEFT JOIN gone ON x.r = gone.r AND x.p = gone.p WHERE gone.p IS NULL GROUP BY x.r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
"""


QUERIES = {"op1_pack": op1_pack, "op2_token_counts": op2_token_counts, "op3_language": op3_language, "op4_quality": op4_quality, "op5_simhash": op5_simhash, "op6_search": op6_search, "op7_lines": op7_lines, "op8_surrogates": op8_surrogates, "op9_passages": op9_passages, "op10_mix": op10_mix}
ORACLES: dict[str, str] = {"op6_search": OP6_SQL, "op7_lines": OP7_SQL, "op9_passages": OP9_SQL}
