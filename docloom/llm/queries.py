"""The dealt operators over their whole tables, with production parameters."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, chat, decontaminate, divergence, embed_dedup, language, packing, pii, quality, runs, simhash, token_file, toxicity

VOCABULARY, BYTE_VOCABULARY = "word_bpe_49k.json", "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


#: A conversation whose texts hold the template's own control strings.
CONFLICT = r"\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONFLICT).alias("text"))
    return chat.digests(turns.unionByName(extra))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out")
    return language.predict(docs.select("doc_id", "text"), model, ["doc_id"]).select("doc_id", held_out, "lang_pred", "score")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.fit_on(docs, table(spark, sf_dir, "labels"), "quality", remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out")
    return quality.score(docs, net, ["doc_id"]).select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind_no"] == pii.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    kinds = [count(kind) for kind in pii.PATTERNS]
    return found.select("doc_id", *kinds, F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"), pii.spans_text(F.array_sort(F.concat("base", "extra"))).alias("spans"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"), "toxic", remainder(5) != 0)
    return toxicity.score(docs, model, ["doc_id"]).select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = token_file.new_folder(docs)
    manifest = token_file.write_documents(docs, public_tokenizers.path(VOCABULARY), folder)
    return token_file.read_documents(manifest, folder, ids=False)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), ids=False, digests=True, keep=["doc_id"])


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("simhash")).alias("fingerprint"), "component_id")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), words AS (
    SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs
), kept AS (
    SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
    SELECT lang, count(*) AS v FROM kept GROUP BY lang
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
    SELECT g.lang, g.source, coalesce(t.n, 0) AS total, coalesce(v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) t USING (lang, source)
    LEFT JOIN langs USING (lang)
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (total + v)::HUGEINT AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), q AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 1)::HUGEINT) // (any_value(total) + any_value(v))::HUGEINT AS q
    FROM counts JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM groups GROUP BY lang) USING (lang) GROUP BY lang, term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(sum(f), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS item, ((x.p - y.p) * (x.p - y.p)) // y.p AS f FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    ) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    GROUP BY a.lang, a.source, b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(BYTE_VOCABULARY))


def repeated_tail(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document (by its id's checksum) goes on with one stretch of words again and again from some word on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs, runs=False, digests=True, rewrite=repeated_tail, keep=["doc_id"])
    exponent = F.expr("length * 1000 div period")
    return found.select("doc_id", "n_runs", "start", "length", "period", exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_language": op2_language,
    "op3_quality": op3_quality,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_toxicity": op6_toxicity,
    "op7_token_file": op7_token_file,
    "op8_bpe": op8_bpe,
    "op9_embeddings": op9_embeddings,
    "op10_simhash": op10_simhash,
    "op11_divergence": op11_divergence,
    "op12_packing": op12_packing,
    "op13_runs": op13_runs,
}
ORACLES: dict[str, str] = {"op11_divergence": DIVERGENCE_SQL}
