"""Text to vectors: hashed, signed word counts (no vocabulary to ship)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T


def _slot(word: str, dim: int) -> tuple[int, float]:
    digest = hashlib.md5(word.encode("utf-8"), usedforsecurity=False).hexdigest()
    return int(digest[:8], 16) % dim, 1.0 if int(digest[8], 16) < 8 else -1.0


def embed_tokens(tokens: Column | str, dim: int = 64, normalize: bool = False) -> Column:
    """Vector of ``dim`` signed counts per token array.

    Each word owns one slot and one sign, read off its MD5 digest: the first
    eight hex digits modulo ``dim``, and plus for a ninth digit below 8.
    Distinct words of a batch are hashed once; the rest is one bincount.
    """

    @F.arrow_udf("array<double>")
    def embed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[str, tuple[int, float]] = {}
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
            encoded = pc.dictionary_encode(pc.list_flatten(batch))
            words = encoded.dictionary.to_pylist()
            if len(known) > 1_000_000:
                known.clear()
            for word in words:
                if word not in known:
                    known[word] = _slot(word, dim)
            slots = np.array([known[word][0] for word in words], dtype=np.int64)
            signs = np.array([known[word][1] for word in words])
            codes = encoded.indices.to_numpy(zero_copy_only=False)
            rows = np.repeat(np.arange(len(batch)), sizes)
            cells = np.bincount(rows * dim + slots[codes], weights=signs[codes], minlength=len(batch) * dim)
            if normalize:
                matrix = cells.reshape(len(batch), dim)
                norms = np.linalg.norm(matrix, axis=1, keepdims=True)
                cells = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0).ravel()
            ends = np.arange(len(batch) + 1, dtype=np.int32) * dim
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(cells), mask=pc.is_null(batch))

    # not marked deterministic: a filter on the vector must not run the function again below it
    return embed.asNondeterministic()(tokens)


def embed_text(df: DataFrame, col: str = "chunk_to_embed", dim: int = 64, normalize: bool = False,
               into: str = "vector") -> DataFrame:
    """Add the vector of a text column (NULL text gives NULL)."""
    return df.withColumn(into, embed_tokens(T.tokens(col), dim, normalize))
