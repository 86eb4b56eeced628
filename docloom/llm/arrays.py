"""Texts of an Arrow batch as flat byte arrays: words, their hashes, bounded slices.

Every function works on a whole batch with numpy, so the cost per word is a few
array operations and no Python call.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

#: Text bytes that one slice of a batch holds, unless a single text is longer.
SLICE_BYTES = 4 << 20
#: Bytes whose running hash is taken at once.
HASH_BYTES = 1 << 20
#: Bytes beyond which two spans are compared by themselves.
LONG_SPAN = 256
MULTIPLIER = 0x9E3779B97F4A7C15


def word_table() -> np.ndarray:
    """Byte to lower-cased word byte, 0 for a separator: words are digits, ASCII letters and all bytes from 0x80."""
    table = np.zeros(256, np.uint8)
    for low, high in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = np.arange(low, high + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array, and where each text starts and ends; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of text, never cutting a text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        limit = (ends[start - 1] if start else 0) + SLICE_BYTES
        stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers over all positions; one to one."""
    h = hashes ^ (hashes >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def chunk_table() -> np.ndarray:
    """Byte plus one, 0 for ASCII white space: chunks are what lies between."""
    table = np.arange(1, 257, dtype=np.uint16)
    table[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = 0
    return table


class WordHasher:
    """Words of packed texts and a 64-bit hash of each word's bytes as the table maps them (0 separates)."""

    def __init__(self, table: np.ndarray | None = None) -> None:
        self.table = word_table() if table is None else table
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, HASH_BYTES + 4096)
            factors = np.full(size, MULTIPLIER, np.uint64)
            factors[0] = 1
            self.powers = np.cumprod(factors)
            factors[1:] = pow(MULTIPLIER, -1, 1 << 64)
            self.inverses = np.cumprod(factors)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, and where each word starts and ends; no word crosses a text."""
        lowered = self.table[data]
        inside = lowered != 0
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[1:] > offsets[:-1]
        begin, end = offsets[:-1][filled], offsets[1:][filled] - 1
        first[begin] = inside[begin]
        last[end] = inside[end]
        return lowered, np.flatnonzero(first), np.flatnonzero(last) + 1

    def hashes(self, lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per word; words are taken in blocks, so memory follows HASH_BYTES or the longest word."""
        out = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + HASH_BYTES, side="right")))
            base, size = starts[a], ends[b - 1] - starts[a]
            self._grow(int(size))
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(lowered[base : base + size] * self.powers[:size], out=sums[1:])
            at = starts[a:b] - base
            out[a:b] = (sums[ends[a:b] - base] - sums[at]) * self.inverses[at]
            a = b
        return mix(out)

    def words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lower-cased bytes, word starts, word ends, word hashes, and the first word of each text (n + 1)."""
        data, offsets = text_bytes(texts)
        lowered, starts, ends = self.spans(data, offsets)
        return lowered, starts, ends, self.hashes(lowered, starts, ends), np.searchsorted(starts, offsets)


def differing(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which spans differ in length or bytes from the span ``of`` names for them."""
    size = ends - starts
    wrong = size != size[of]
    left = np.flatnonzero(~wrong & (of != np.arange(len(of))))
    for i in left[size[left] > LONG_SPAN].tolist():
        k = of[i]
        wrong[i] = not np.array_equal(data[starts[i] : ends[i]], data[starts[k] : ends[k]])
    left = left[size[left] <= LONG_SPAN]
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))  # the eight bytes from each place on
    low = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    at = 0
    while len(left):
        rest = size[left] - at
        off = (eight[starts[left] + at] ^ eight[starts[of[left]] + at]) & low[np.minimum(rest, 8)]
        wrong[left[off != 0]] = True
        left = left[(off == 0) & (rest > 8)]
        at += 8
    return wrong


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A span for each distinct one, and which of them every span is. Hashes find them; their bytes are compared, so equal hashes settle nothing."""
    n = len(starts)
    which = pa.array(hashes).dictionary_encode().indices.to_numpy().astype(np.int64)
    at = np.zeros(int(which.max()) + 1 if n else 0, np.int64)
    at[which[::-1]] = np.arange(n)[::-1]
    wrong = np.flatnonzero(differing(data, starts, ends, at[which]))
    if len(wrong):
        own: dict[bytes, int] = {}
        raw = [data[starts[i] : ends[i]].tobytes() for i in wrong.tolist()]
        which[wrong] = [own.setdefault(b, len(at) + len(own)) for b in raw]
        first = {b: i for b, i in zip(raw[::-1], wrong[::-1].tolist(), strict=True)}
        at = np.concatenate([at, [first[b] for b in own]])
    return at, which


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; ``first`` has the first position of each text and the total length."""
    out = np.zeros(len(first) - 1, np.float64)
    filled = first[1:] > first[:-1]
    if filled.any():
        out[filled] = np.add.reduceat(values, first[:-1][filled], dtype=np.float64)
    return out


class Member:
    """Membership and position of 64-bit hashes in a sorted set; a bit table first turns most away."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = max(12, min(24, int(np.ceil(np.log2(max(len(keys), 1) * 16)))))
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self._slot(keys)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` whose value is a key, and which key it is."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[self._slot(hashes)])
        key = np.searchsorted(self.keys, hashes[at])
        key[key == len(self.keys)] = 0
        same = self.keys[key] == hashes[at]
        return at[same], key[same]


def arrow_batches(df: DataFrame) -> None:
    """Bound the whole texts that a Python worker gets at once."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def by_text(df: DataFrame, function: Callable[[pa.RecordBatch], list[pa.Array]], added: list[tuple[str, st.DataType]], keep: list[str] | None = None, reads: tuple[str, ...] = ()) -> DataFrame:
    """Add columns computed from slices of whole texts (column ``text``); rows stay in their tasks.

    ``function`` is called as ``function()`` once per task and returns what maps
    a slice to the added columns. ``keep`` names the columns to carry (all),
    ``reads`` those that the function needs besides.
    """
    arrow_batches(df)
    keep = df.columns if keep is None else keep
    schema = st.StructType([df.schema[c] for c in keep] + [st.StructField(n, t) for n, t in added])

    # mapInArrow reads a dot in a name as a field of a struct
    sent = {c: c if "." not in c else f"__dotted{k}" for k, c in enumerate(dict.fromkeys([*keep, "text", *reads]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = function()
        for batch in batches:
            for part in slices(batch):
                columns = [part.column(sent[c]) for c in keep] + list(work(part))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    needed = [F.col("`" + c.replace("`", "``") + "`").alias(n) for c, n in sent.items()]
    return df.select(*needed).mapInArrow(run, schema)


def fraction_of(n_rows: int, wanted: int) -> float:
    """Share of rows that gives about ``wanted`` of them, with room for chance."""
    return 1.0 if n_rows <= wanted else min(1.0, 1.2 * wanted / n_rows + 100 / n_rows)


def bounded_sample(df: DataFrame, wanted: int, *columns: str) -> DataFrame:
    """At most ``wanted`` rows, those whose hash of ``columns`` is smallest; all rows where they are no more.

    Only hashes are sorted for the cut; the rows stay in their tasks, unless so
    many share the last hash that a limit must choose among them.
    """
    n_rows, rank = df.count(), F.xxhash64(*columns)
    if n_rows <= wanted:
        return df
    likely = rank < F.lit(int(-(2**63) + fraction_of(n_rows, wanted) * (2**64 - 1)))
    last = df.where(likely).select(rank.alias("rank")).orderBy("rank").limit(wanted).agg(F.max("rank")).first()[0]
    if last is None:  # few distinct hashes, none of them likely
        return df.orderBy(rank).limit(wanted)
    kept = df.where(rank <= F.lit(last))
    return kept if kept.count() <= wanted else kept.orderBy(rank).limit(wanted)
