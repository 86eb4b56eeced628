"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a document are the distinct hashes of its words, word pairs and pairs
with one word between. FTRL-proximal keeps a learning rate for each coordinate,
and its L1 term leaves most weights at exactly zero: what is broadcast is the
sorted hashes and weights of the others, whose number the sample bounds.

Learning uses at most ``SAMPLE_ROWS`` labelled documents of at most
``SAMPLE_CHARS`` characters, chosen by a hash; every document is scored whole.

Edge cases: NULL and wordless texts get the score of the bias alone; without
labelled rows the score is 0; NULL labels are not learned from; a document with
several labels is learned from once for each; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.llm.arrays import Member, WordHasher, arrow_batches, bounded_sample, by_text, mix, slices, sums_by_text
from docloom.session import materialize

#: Bounds of the sample that is learned from.
SAMPLE_ROWS, SAMPLE_CHARS = 6_000, 6_000
PASSES, BATCH_ROWS = 10, 16
ALPHA, BETA, L1, L2 = 4.0, 1.0, 12.0, 0.0
#: Weight of the rows of label 1: this share of what would make both labels weigh the same.
BALANCE = 0.5
#: Coordinates must occur in so many documents of the sample.
LEAST_DOCS = 3
SKIPS = (1, 2)


def features(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, pairs and skip pairs, and the text each belongs to (not yet distinct)."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found, of = [words], [text]
    for skip in SKIPS:
        same = np.flatnonzero(text[:-skip] == text[skip:]) if len(text) > skip else np.zeros(0, np.int64)
        found.append(mix(words[same] * np.uint64(0x9DDFEA08EB382D69) + words[same + skip] + np.uint64(skip)))
        of.append(text[same])
    return np.concatenate(found), np.concatenate(of)


def sample_features(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sampled rows, and their distinct features as (row, hash)."""
    arrow_batches(labelled)

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch):
                _, _, _, words, first = hasher.words(part.column("text"))
                hashes, text = features(words, first)
                order = np.lexsort((hashes, text))
                hashes, text = hashes[order], text[order]
                new = np.ones(len(text), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
                hashes, text = hashes[new], text[new]
                ends = np.searchsorted(text, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays([part.column("label"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes.view(np.int64)))], names=["label", "hashes"])

    table = labelled.select("label", "text").mapInArrow(run, "label int, hashes array<long>").toArrow().combine_chunks()
    if not table.num_rows:
        return np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lists = table.column("hashes").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    labels = table.column("label").to_numpy().astype(float)
    return labels, np.repeat(np.arange(len(labels), dtype=np.int32), sizes), lists.values.to_numpy()[lists.offsets[0].as_py() :].view(np.uint64)


def fit(labels: np.ndarray, row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over small batches; the sorted hashes and weights that aren't zero, and the bias."""
    if not len(labels) or labels.min() == labels.max():
        return np.zeros(0, np.uint64), np.zeros(0), (-50.0 if not labels.sum() else 50.0)
    keys, seen = np.unique(hashes, return_counts=True)
    keys = keys[seen >= LEAST_DOCS]
    at, coordinate = Member(keys).find(hashes)
    row = row[at]
    bias = len(keys)  # the last coordinate, in every row
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)
    begin = np.searchsorted(row, np.arange(len(labels) + 1))
    # an order that doesn't depend on how Spark dealt the rows: by the rows' own features
    own = np.array([int(hashes_of.sum(dtype=np.uint64)) if len(hashes_of := keys[coordinate[begin[i] : begin[i + 1]]]) else 0 for i in range(len(labels))], np.uint64)
    order = np.argsort(mix(own), kind="stable")

    rare = max(1.0, BALANCE * float((len(labels) - labels.sum()) / labels.sum()))  # label 1 is seldom: its rows weigh more

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1 * (at != bias), 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(PASSES):
        for low in range(0, len(order), BATCH_ROWS):
            rows = order[low : low + BATCH_ROWS]
            parts = [np.append(coordinate[begin[i] : begin[i + 1]], bias) for i in rows]
            at, back = np.unique(np.concatenate(parts), return_inverse=True)
            of = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[back], len(rows)), -35, 35)))
            g = np.bincount(back, ((p - labels[rows]) * np.where(labels[rows] == 1, rare, 1.0))[of], len(at))
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(bias + 1))
    used = np.flatnonzero(w[:-1])
    return keys[used], w[used], float(w[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], keep: list[str] | None = None) -> DataFrame:
    """Add ``score``: the probability of label 1. A column of this name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != "score"]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        keys, weights, bias = sent.value
        hasher, member = WordHasher(), Member(keys)

        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            _, _, _, words, first = hasher.words(batch.column("text"))
            hashes, text = features(words, first)
            at, key = member.find(hashes)
            pair = np.unique(text[at] * max(len(keys), 1) + key)  # each feature of a text counts once
            total = bias + np.bincount(pair // max(len(keys), 1), weights[pair % max(len(keys), 1)] if len(keys) else None, batch.num_rows)
            return [pa.array(1 / (1 + np.exp(-np.clip(total, -50, 50))), pa.float64())]

        return add

    return by_text(docs, work, [("score", st.DoubleType())], keep)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Fit on a bounded sample of documents with a label; ``learn`` says which document ids may be learned from."""
    told = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label")).where("label IS NOT NULL AND doc_id IS NOT NULL")
    told = told if learn is None else told.where(learn)
    # at most SAMPLE_ROWS ids and labels, so that texts are never shuffled to meet them
    sample = F.broadcast(materialize(bounded_sample(told, SAMPLE_ROWS, "doc_id", "label"), "label-sample"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id")
    rows = rows.where(F.length("text") <= SAMPLE_CHARS).orderBy(F.xxhash64("doc_id", "text")).limit(SAMPLE_ROWS)
    return fit(*sample_features(rows))
