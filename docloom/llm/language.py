"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything else is one space; n-grams of 1 to ``ORDERS``
characters are hashed into ``BUCKETS``. Their counts per language, smoothed, give a
matrix of log probabilities whose size (languages x buckets) is checked before it
is broadcast. A batch is scored in numpy: its n-grams are the entries of a sparse
document x bucket matrix, which is multiplied by the log probabilities column by
column.

Learning uses at most ``SAMPLE_ROWS`` rows with a language, chosen by a hash; their
n-grams are counted where they are read. Every text is scored whole.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0; with no
language learned all are; ties go to the language that sorts first; NULL languages
aren't learned from; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.llm.arrays import arrow_batches, bounded_sample, by_text, slices, sums_by_text

SAMPLE_ROWS = 20_000
ORDERS, BUCKETS = 3, 1 << 16
SMOOTHING = 0.5
#: Languages that a task holds the log probabilities of at once: 64 MB.
BLOCK_LANGS = 256
UNKNOWN = "und"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def letter_codes() -> np.ndarray:
    """Code point of each letter, 32 (space) for any other code point."""
    codes = np.arange(0x110000, dtype=np.uint32)
    codes[[not chr(c).isalpha() for c in range(0x110000)]] = 32
    return codes


def grams(texts: list[str], letters: np.ndarray, buckets: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram, where each text's n-grams start, and whether each text has a letter."""
    lower = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lower], np.int64)
    codes = letters[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)]
    first = np.concatenate([[0], np.cumsum(sizes)])
    has = np.concatenate([[0], np.cumsum(codes != 32)])
    has = has[first[1:]] > has[first[:-1]]
    values, shift = codes.astype(np.uint64), np.uint64(65 - buckets.bit_length())
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found = []
    for order in range(1, ORDERS + 1):
        if order > 1:
            values = values[:-1] * np.uint64(0x100000001B3) + codes[order - 1 :] if len(values) else values
        n = len(values)
        kept = (text[:n] == text[order - 1 : order - 1 + n]) & (codes[:n] != 32)
        places = ((values[kept] + np.uint64(order << 56)) * MULTIPLIER >> shift).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(np.bincount(text[:n][kept], minlength=len(texts)))]) if n else np.zeros(len(texts) + 1, np.int64)
        found.append((places, starts, has))
    return found


def count_grams(labelled: DataFrame, buckets: int) -> DataFrame:
    """Counts of the n-grams of rows (lang, text), added up: (lang, bucket, n)."""
    arrow_batches(labelled)

    def run(batches):
        letters = letter_codes()
        for batch in batches:
            for part in slices(batch):
                langs, lang = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
                total = np.zeros(len(langs) * buckets, np.int64)
                for places, starts, _ in grams([t or "" for t in part.column("text").to_pylist()], letters, buckets):
                    total += np.bincount(np.repeat(lang, np.diff(starts)) * buckets + places, minlength=len(total))
                total = total.reshape(len(langs), buckets)
                row, bucket = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(langs[row], pa.string()), pa.array(bucket, pa.int32()), pa.array(total[row, bucket], pa.int64())], names=["lang", "bucket", "n"])

    return labelled.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log probabilities (bucket x language), the prior in an extra last row."""
    sample = bounded_sample(labelled.where("lang IS NOT NULL").select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")), rows, "doc_id", "lang")
    held = sample.groupBy("lang").count().orderBy("lang").collect()
    langs = [r["lang"] for r in held]
    if not langs:
        return [], np.zeros((BUCKETS + 1, 0), np.float32)
    counts = np.zeros((BUCKETS, len(langs)), np.float32)
    table = count_grams(sample, BUCKETS).toArrow()  # at most as many rows as the bounded sample has n-grams
    column = {lang: k for k, lang in enumerate(langs)}
    counts[table.column("bucket").to_numpy(), [column[x] for x in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
    counts += SMOOTHING
    prior = np.array([r["count"] for r in held], float)
    return langs, np.vstack([np.log(counts / counts.sum(axis=0, dtype=np.float64)), np.log(prior / prior.sum())]).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (its posterior probability); columns of these names are replaced.

    More languages than ``BLOCK_LANGS`` are scored block by block, each with the best of the blocks before it.
    """
    langs, matrix = model
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score", "__total", "__best")]
    out = docs.select(*dict.fromkeys([*keep, "text"]))
    out = out.withColumns({"lang_pred": F.lit(UNKNOWN), "__best": F.lit(float("-inf")), "__total": F.lit(float("-inf"))})
    for low in range(0, max(len(langs), 1), BLOCK_LANGS):
        block = (langs[low : low + BLOCK_LANGS], np.ascontiguousarray(matrix[:, low : low + BLOCK_LANGS]))
        last = low + BLOCK_LANGS >= len(langs)
        out = _scored(out, block, keep if last else list(dict.fromkeys([*keep, "text"])))
    return out.select(*keep, "lang_pred", F.when(F.col("lang_pred") == UNKNOWN, 0.0).otherwise(F.exp(F.col("__best") - F.col("__total"))).alias("score"))


def _scored(docs: DataFrame, block: tuple[list[str], np.ndarray], keep: list[str]) -> DataFrame:
    """The best language so far, its log probability and the logarithm of the sum of all, with one more block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)
    found = ["lang_pred", "__best", "__total"]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        langs, matrix = sent.value
        columns = [np.ascontiguousarray(matrix[:-1, k]) for k in range(len(langs))]
        letters, buckets = letter_codes(), len(matrix) - 1

        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            n = batch.num_rows
            total = np.tile(matrix[-1].astype(np.float64), (n, 1))
            has = np.zeros(n, bool)
            for places, starts, has in grams([t or "" for t in batch.column("text").to_pylist()], letters, buckets):
                for k, logs in enumerate(columns):
                    total[:, k] += sums_by_text(logs[places], starts)
            names, best, whole = (batch.column(c) for c in found)
            if langs:
                best, whole = best.to_numpy(), whole.to_numpy()
                top = total.max(axis=1)
                better = has & (top > best)  # ties go to the language that comes first
                names = [langs[k] if b else name for k, b, name in zip(total.argmax(axis=1), better, names.to_pylist(), strict=True)]
                whole = np.logaddexp(whole, top + np.log(np.exp(total - top[:, None]).sum(axis=1)))
                best = np.maximum(best, top)
            return [pa.array(names, pa.string()), pa.array(best, pa.float64()), pa.array(whole, pa.float64())]

        return add

    added = [("lang_pred", st.StringType()), ("__best", st.DoubleType()), ("__total", st.DoubleType())]
    return by_text(docs, work, added, [c for c in keep if c not in found], reads=tuple(found))
