"""A training-data pipeline over ``documents``, one operator a stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bpe, decontaminate, pii, simhash, toxicity
from docloom.llm.queries import VOCABULARY, table
from docloom.session import materialize, scratch_folder


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeps_columns(stage: Stage) -> Stage:
    """A stage that sees ``doc_id``, ``text`` and all other columns under numbers, so their names clash with none of its own."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in ("doc_id", "text") else f"kept_column_{k}" for k, c in enumerate(docs.columns)}
        out = stage(spark, docs.toDF(*names.values()), sf_dir)
        return out.select(*(F.col(n).alias(c) for c, n in names.items()))

    return run


@keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled ones that are here.

    NULL and wordless texts have the score of the bias alone; equal rows share their lot;
    without labels nothing goes; an empty table stays empty; long texts are scored whole.
    """
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"), "toxic")
    return toxicity.score(docs, model).where(F.col("score") < 0.5)


@keeps_columns
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one of the smallest doc_id (NULL last), then of the smallest text hash.

    Groups are those of the SimHash operator with its shingle length and bit distance.
    Only what goes is joined back to the texts; equal rows are told apart last. An
    empty table stays empty; NULL, empty and blank texts are one group.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.col("doc_id").isNull().alias("is_null"))
    found = materialize(simhash.near_duplicates(keyed, keys=("is_null", "text_key")), "copies")
    row = F.struct("is_null", "doc_id", "text_key")
    counted = found.groupBy("component", "is_null", "doc_id", "text_key").agg(F.count("*").alias("n"))
    first = counted.groupBy("component").agg(F.min(row).alias("first"))
    marked = counted.join(first, "component").withColumn("stays", row == F.col("first"))
    marked = materialize(marked.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "stays", "n"), "marked")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.xxhash64("text").eqNullSafe(F.col("key"))
    kept = docs.join(marked.where("NOT stays OR n > 1"), same, "left_anti")
    repeated = docs.join(marked.where("stays AND n > 1"), same, "left_semi").withColumn("key", F.xxhash64("text")).dropDuplicates(["doc_id", "key"])
    return kept.unionByName(repeated.drop("key"))


@keeps_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    NULL and wordless texts hold none and stay, as does all where the benchmark is empty;
    equal rows share their lot; an empty table stays empty; long texts are read whole.
    """
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where(F.col("n_hit") == 0)


@keeps_columns
def hide_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in every text gives way to its kind in brackets; the other columns stay as they were.

    Every row stays; NULL and empty texts stay as they are; of overlapping spans the first
    counts; equal rows change alike; long texts are read whole.
    """
    return pii.redact(docs, pii.find(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left (``n_tokens``, ``ids``), beside its other columns but the text; columns of these names are replaced.

    NULL, empty and blank texts have no ids; equal rows have equal ids; an empty table gives no rows.
    """
    return bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), keep=[c for c in docs.columns if c != "text"])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_copies),
    ("benchmark decontamination", drop_contaminated),
    ("pii", hide_personal),
    ("bpe", tokenize),
]

#: SQL can't express the trained and tokenizing stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
