"""Benchmark passages inside documents, by a prefix-filtered set join.

Every benchmark item is cut into windows of ``WINDOW`` consecutive words (a
shorter item is one window). A document holds a window only if it holds all its
words, so with the words ordered by rarity in the corpus one word is a necessary
prefix: the rarest. Documents are joined to windows on that word alone. Length and
position bounds drop windows that would reach beyond the document; the rest is
verified word by word over the window, at the place the prefix word fixes, and
finally on the words' bytes.

The corpus is read twice: once to count the benchmark's words, once to join. No
text is shuffled; a document is settled in the task that reads it, so neither a
hot source nor a passage that most documents share moves or multiplies rows.
Windows reach the tasks in blocks of at most ``BLOCK_WINDOWS``; a larger benchmark
takes more blocks, one after the other over the same rows.

Edge cases: NULL and wordless texts have no words, hits or windows; repeated
documents are settled each; equal windows of several items count for all; an item
without an id counts under the empty id; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.llm.arrays import Member, WordHasher, arrow_batches, by_text, slices
from docloom.session import materialize

WINDOW = 10
#: Rows of windows that tasks hold at once, and item ids that one row has on average at most: about 60 MB.
BLOCK_WINDOWS, ROW_ITEMS = 200_000, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: runs of digits, ASCII letters (lower-cased) and all else beyond ASCII."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORDS), 0)


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows (words joined by spaces, number of words) with the ids of the items that have them.

    A window of many items has a row for every ``ROW_ITEMS`` or so of them, so no list grows with the benchmark.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    size, long = F.size("words"), F.col("words")
    for k in range(1, window):  # a word more each time, for all windows at once
        long = F.zip_with(F.slice(long, 1, size - k), F.slice("words", k + 1, size - k), lambda a, b: F.concat(a, F.lit(" "), b))
    cut = F.when(size >= window, long).otherwise(F.array(F.array_join("words", " ")))
    rows = items.select("item", F.least(size, F.lit(window)).alias("n"), F.explode(cut).alias("window"))
    held = rows.groupBy("window").agg(F.ceil(F.count("*") / ROW_ITEMS).alias("parts")).where("parts > 1")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("item"), "parts")).otherwise(F.lit(0))
    return rows.join(held, "window", "left").groupBy("window", part.alias("part")).agg(F.max("n").alias("n"), F.collect_set("item").alias("items")).drop("part")


def word_counts(docs: DataFrame, words: np.ndarray) -> DataFrame:
    """How often each of these word hashes (sorted) occurs in all documents: (place, n)."""
    arrow_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, member = WordHasher(), Member(words)
        total = np.zeros(len(words), np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(member.find(hasher.words(part.column("text"))[3])[1], minlength=len(words))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["place", "n"])

    return docs.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))


def hash_words(words: list[str]) -> np.ndarray:
    """The hash that a word of this spelling has in any text."""
    return WordHasher().words(pa.array(words, pa.string()))[3]


class WindowIndex:
    """The windows of one block, found by their rarest word."""

    def __init__(self, windows: list[str], sizes: np.ndarray, hashes: np.ndarray, rarest: np.ndarray) -> None:
        self.words = [w.encode().split(b" ") for w in windows]
        self.sizes, self.hashes = sizes, hashes
        prefixes = hashes[np.arange(len(windows)), rarest]
        order = np.argsort(prefixes, kind="stable")
        self.prefix, self.first, self.count = np.unique(prefixes[order], return_index=True, return_counts=True)
        self.order, self.offset = order, rarest[order]
        self.member = Member(self.prefix)

    def matches(self, lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence; ``first`` has the first word of each text."""
        at, key = self.member.find(words)
        text = np.searchsorted(first, at, side="right") - 1
        found_at, found = [], []
        step = max(1, (1 << 20) // max(int(self.count.max(initial=1)), 1))
        for low in range(0, len(at), step):
            many = self.count[key[low : low + step]]
            row = np.repeat(np.arange(low, low + len(many)), many)
            place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.first[key[low : low + step]], many)
            window = self.order[place]
            begin = at[row] - self.offset[place]
            # position and length bounds: the window lies inside its text
            inside = (begin >= first[text[row]]) & (begin + self.sizes[window] <= first[text[row] + 1])
            begin, window = begin[inside], window[inside]
            for k in range(self.hashes.shape[1]):
                with_word = self.sizes[window] > k
                same = ~with_word | (words[np.minimum(begin + k, len(words) - 1)] == self.hashes[window, k])
                begin, window = begin[same], window[same]
            found_at.append(begin)
            found.append(window)
        begin, window = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_at, found))
        same = [[lowered[starts[b + k] : ends[b + k]].tobytes() for k in range(len(self.words[w]))] == self.words[w] for b, w in zip(begin, window, strict=True)]
        same = np.array(same, bool)
        return begin[same], window[same]


def rarest_words(rows: list, counts: dict[int, int], places: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """A block's windows, their sizes, their words' hashes and which word is rarest (ties: the earlier one), as a WindowIndex takes them."""
    sizes = np.array([r["n"] for r in rows], np.int64)
    hashes = np.zeros((len(rows), int(sizes.max(initial=1))), np.uint64)
    hashes[np.arange(hashes.shape[1]) < sizes[:, None]] = hash_words([w for r in rows for w in r["window"].split(" ")])
    frequency = np.array([counts.get(n, 0) for n in range(len(places))] or [0], np.int64)
    rarity = frequency[np.searchsorted(places, hashes).clip(0, len(frequency) - 1)]
    rarity[np.arange(hashes.shape[1]) >= sizes[:, None]] = np.iinfo(np.int64).max
    return [r["window"] for r in rows], sizes, hashes, rarity.argmin(axis=1)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK_WINDOWS) -> DataFrame:
    """Add ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``hits`` and ``items``.

    ``hits``: disjoint ascending word ranges [first, last) as a flat array;
    ``items``: sorted distinct ids of the items with occurring windows. Columns of
    these names are replaced.
    """
    spark = docs.sparkSession
    own = ["n_words", "hits", "items", "n_hit"]
    docs = docs.select(*(c for c in docs.columns if c.lower() not in own))
    windows = materialize(windows_of(benchmark, window), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    out = docs.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.array().cast("array<long>"), "items": F.array().cast("array<string>")})
    part = F.pmod(F.xxhash64("window", "items"), F.lit(blocks))
    for n in range(blocks):
        rows = windows.where(part == n).collect()  # at most about BLOCK_WINDOWS rows of WINDOW words
        places = np.unique(hash_words([w for r in rows for w in r["window"].split(" ")]))
        counts = {r["place"]: r["n"] for r in word_counts(docs, places).collect()} if rows else {}
        index = spark.sparkContext.broadcast((rarest_words(rows, counts, places), [r["items"] for r in rows]))
        out = _join(out, index)
    signed = F.transform("hits", lambda x, k: F.when(k % 2 == 0, -x).otherwise(x))
    return out.withColumn("n_hit", F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x))


def _join(docs: DataFrame, index) -> DataFrame:
    """Add one block's hits and items to those found so far."""
    added = [("n_words", st.LongType()), ("hits", st.ArrayType(st.LongType())), ("items", st.ArrayType(st.StringType()))]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        hasher = WordHasher()
        parts, items = index.value
        windows = WindowIndex(*parts)

        def add(batch: pa.RecordBatch) -> list[pa.Array]:
            lowered, starts, ends, words, first = hasher.words(batch.column("text"))
            begin, window = windows.matches(lowered, starts, ends, words, first)
            hits, names = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            text = np.searchsorted(first, begin, side="right") - 1
            order = np.lexsort((begin, text))
            begin, window, text = begin[order], window[order], text[order]
            for i in np.unique(text):
                a, b = np.searchsorted(text, [i, i + 1])
                low = begin[a:b] - first[i]
                old = np.array(hits[i], np.int64).reshape(-1, 2)
                hits[i] = merged(np.concatenate([old[:, 0], low]), np.concatenate([old[:, 1], low + windows.sizes[window[a:b]]]))
                names[i] = sorted({*names[i], *(x for w in np.unique(window[a:b]) for x in items[w])})
            return [pa.array(np.diff(first), pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))]

        return add

    return by_text(docs, work, added, [c for c in docs.columns if c not in ("n_words", "hits", "items")], reads=("hits", "items"))


def merged(lows: np.ndarray, highs: np.ndarray) -> list[int]:
    """Union of ranges as a flat list of disjoint ascending ranges."""
    order = np.argsort(lows, kind="stable")
    lows, reach = lows[order], np.maximum.accumulate(highs[order])
    new = np.concatenate([[True], lows[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lows) - 1]])
    return np.column_stack([lows[new], reach[last]]).ravel().tolist()
