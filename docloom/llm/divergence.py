"""Divergence of sources from each other and from their language, by in-mapper stripes.

A task folds whole documents into stripes: for each term of a language the number of
documents that hold it, and how often each source does. Stripes leave the task when they
fill its memory, and at its end; they are merged by term, so a common word costs a task a
row, not a row per use, and a hot source or language is spread over all its terms. The
empty term's stripe names all sources of a language, those without terms as well.

Merged stripes then give the divergences themselves. With the kept terms' counts of each
group (language, source) a task adds up, stripe by stripe, what each pair of sources differs
by; only these sums leave it. Terms that neither source has all add the same, so a stripe
only touches the sources it holds. Of the terms a source has more of than its language,
a task keeps each group's best ``TOP``.

Shares are whole billionths: p = 1 + floor(SCALE (count + 1) / (N + V)), f = floor((p - q)^2 / q).
Integers are exact: what could pass 63 bits is computed with Python's own.

The groups are what a task must know; they are counted, and dealt by language and source
into blocks of about ``GROUPS``, of a language no more than about ``SOURCES``. Each pass over
the stripes holds one block of sources against another, so what is sent is bounded.

Edge cases: NULL text, language or source is the empty string; a group without terms has
every count zero; a language without kept terms gives pairs of value 0 and no terms; ties
go by item; repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.arrays import arrow_batches
from docloom.session import materialize

LEAST_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
#: Entries of a task's stripes before they are sent, and text folded at once.
ENTRIES, BLOCK_BYTES = 1_000_000, 4 << 20
#: Groups that a block holds, sources of one language in it, and (term, source) cells computed at once.
GROUPS, SOURCES, CELLS = 50_000, 2_000, 1 << 20
#: Counts up to this keep SCALE times them in 63 bits.
PLAIN = 2**62 // SCALE

STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"


def term_table() -> bytes:
    """Byte to byte: terms are ASCII letters, lower-cased, and all bytes from 0x80; the rest parts them."""
    kept = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    table = bytearray(b" " * 256)
    for b in kept:
        table[b] = b + 32 if b < 0x5B else b
    return bytes(table)


TERMS = term_table()


def blocks_of(text: str) -> Iterator[list[bytes]]:
    """A text's terms, of some megabytes of text at a time; no term is cut."""
    raw = text.encode("utf-8", "surrogatepass").translate(TERMS)
    start = 0
    while start < len(raw):
        stop = raw.find(b" ", start + BLOCK_BYTES)
        stop = len(raw) if stop < 0 else stop
        yield raw[start:stop].split()
        start = stop


# ----------------------------------------------------------- the stripes ----
class Stripes:
    """One task's stripes."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[tuple[str, str], Counter] = defaultdict(Counter)

    def fold(self, lang: str, source: str, text: str) -> None:
        """A whole document."""
        counts, seen = self.counts[lang, source], set()
        for terms in blocks_of(text):
            counts.update(terms)
            seen.update(terms)
        self.docs[lang].update(seen)

    def full(self) -> bool:
        return sum(map(len, self.docs.values())) + sum(map(len, self.counts.values())) > ENTRIES

    def rows(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows; none are left."""
        of: dict[str, dict[bytes, tuple[list[str], list[int]]]] = defaultdict(dict)
        for (lang, source), counts in self.counts.items():
            stripes = of[lang]
            for term, n in ((b"", 0), *counts.items()):
                if term not in stripes:
                    stripes[term] = [], []
                sources, numbers = stripes[term]
                sources.append(source)
                numbers.append(n)
        for lang, stripes in of.items():
            docs, terms = self.docs[lang], list(stripes)
            for low in range(0, len(terms), 20_000):
                part = terms[low : low + 20_000]
                columns = [[lang] * len(part), [t.decode("utf-8", "surrogatepass") for t in part], [docs[t] for t in part], *([stripes[t][k] for t in part] for k in range(2))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())), strict=True)], names=["lang", "term", "docs", "sources", "counts"])
        self.docs.clear()
        self.counts.clear()


def stripes(docs: DataFrame) -> DataFrame:
    """Unmerged stripes (STRIPE) of documents (text, lang, source)."""
    arrow_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True):
                held.fold(lang or "", source or "", text or "")
                if held.full():
                    yield from held.rows()
        yield from held.rows()

    return docs.select("text", F.col("lang").cast("string"), F.col("source").cast("string")).mapInArrow(run, STRIPE)


def merge_neighbours(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of one key that follow each other as one row: documents added, and counts by source."""
    n = batch.num_rows
    changes = np.ones(n, bool)
    for c in ("lang", "term"):
        values = batch.column(c)
        differ = pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
        changes[1:] = differ if c == "lang" else changes[1:] | differ
    first = np.flatnonzero(changes)
    sources = batch.column("sources")
    names = sources.flatten().dictionary_encode()
    sizes = pc.list_value_length(sources).to_numpy(zero_copy_only=False)
    key = np.repeat(np.cumsum(changes) - 1, sizes) * max(len(names.dictionary), 1) + names.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.add.reduceat(batch.column("counts").flatten().to_numpy()[order], at) if len(key) else np.zeros(0, np.int64)
    ends = pa.array(np.searchsorted(key[at] // max(len(names.dictionary), 1), np.arange(len(first) + 1)), pa.int32())
    docs = np.add.reduceat(batch.column("docs").to_numpy(), first)
    lists = [pa.ListArray.from_arrays(ends, x) for x in (names.dictionary.take(names.indices.take(pa.array(order[at]))), pa.array(counts))]
    return pa.RecordBatch.from_arrays([batch.column("lang").take(pa.array(first)), batch.column("term").take(pa.array(first)), pa.array(docs), *lists], names=batch.schema.names)


def merged(rows: DataFrame) -> DataFrame:
    """One stripe for each language and term. Parts come sorted and are folded as they come, so a term of many parts needs no more memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                done = merge_neighbours(pa.concat_batches([*held, batch]) if held else batch)
                yield done.slice(0, done.num_rows - 1)
                held = [done.slice(done.num_rows - 1)]
        yield from held

    return rows.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, STRIPE)


# ------------------------------------------------------- the divergences ----
def shares(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE (count + 1) / total), exact."""
    if counts.size and int(counts.max()) > PLAIN:
        return (1 + SCALE * (counts.astype(object) + 1) // np.asarray(total, object)).astype(np.int64)
    return 1 + SCALE * (counts + 1) // total


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are a little over SCALE at most, so squares keep to 63 bits."""
    off = p - q
    return off * off // q


class Side:
    """The sources of one language that one side of a pass knows."""

    def __init__(self, names: list[str], totals: list[int], kept: int) -> None:
        self.names, self.at = names, {name: k for k, name in enumerate(names)}
        self.total = np.array(totals, np.int64) + kept
        self.none = shares(np.zeros(len(names), np.int64), self.total) if kept else np.ones(len(names), np.int64)

    def counts(self, of: np.ndarray, source: list[str], n: np.ndarray, rows: int) -> np.ndarray:
        """Counts of these sources in each of ``rows`` terms."""
        at = np.array([self.at.get(s, -1) for s in source], np.int64)
        out = np.zeros((rows, len(self.names)), np.int64)
        known = at >= 0
        out[of[known], at[known]] = n[known]
        return out


class Language:
    """What one task adds up for one language in one pass: pair sums, and each group's best terms."""

    def __init__(self, known: dict, own: bool, top: int) -> None:
        self.left, self.right = (Side(*known[side]) for side in ("left", "right"))
        self.kept, self.total, self.own, self.top = known["kept"], known["total"], own, top
        self.base = divergence(self.left.none[:, None], self.right.none[None, :])
        self.sums = np.zeros(self.base.shape, np.int64)
        self.whole = False
        self.best: dict[int, list[tuple[int, str]]] = defaultdict(list)

    def add(self, terms: list[str], lists: list[list[str]], counts: list[list[int]]) -> None:
        step = max(1, CELLS // max(1, len(self.left.names), len(self.right.names)))
        for low in range(0, len(terms), step):
            self._add(terms[low : low + step], lists[low : low + step], counts[low : low + step])

    def _add(self, terms: list[str], lists: list[list[str]], counts: list[list[int]]) -> None:
        if "" in terms:  # the stripe of all sources
            self.sums += self.kept * self.base
            self.whole = True
            k = terms.index("")
            terms, lists, counts = (x[:k] + x[k + 1 :] for x in (terms, lists, counts))
        of = np.repeat(np.arange(len(terms)), [len(x) for x in lists])
        sources, n = [s for x in lists for s in x], np.array([c for x in counts for c in x], np.int64)
        left, right = (side.counts(of, sources, n, len(terms)) for side in (self.left, self.right))
        p, q = shares(left, self.left.total), shares(right, self.right.total)
        for k in np.flatnonzero(left.any(axis=0)).tolist():
            rows = np.flatnonzero(left[:, k])
            self.sums[k] += divergence(p[rows, k, None], q[rows]).sum(axis=0) - len(rows) * self.base[k]
        for k in np.flatnonzero(right.any(axis=0)).tolist():
            rows = np.flatnonzero(right[:, k])
            other = np.where(left[rows] == 0, divergence(self.left.none, q[rows, k, None]) - self.base[:, k], 0)
            self.sums[:, k] += other.sum(axis=0)
        if self.own and terms:
            overall = shares(np.array([sum(c) for c in counts], np.int64), self.total + self.kept)
            for k in range(len(self.left.names)):
                rows = np.flatnonzero((left[:, k] > 0) & (p[:, k] > overall))
                value = divergence(p[rows, k], overall[rows])
                if len(rows) > self.top:
                    likely = value >= np.partition(value, len(value) - self.top)[len(value) - self.top]
                    rows, value = rows[likely], value[likely]
                self.best[k] = sorted([*self.best[k], *((-v, terms[r]) for v, r in zip(value.tolist(), rows.tolist(), strict=True))])[: self.top]

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        for k, name in enumerate(self.left.names):
            told = [(name, self.right.names[j], int(self.sums[k, j])) for j in (range(len(self.right.names)) if self.whole else np.flatnonzero(self.sums[k]).tolist()) if self.right.names[j] != name]
            yield _rows(lang, "pair", told)
            yield _rows(lang, "term", [(name, term, -value) for value, term in self.best.get(k, [])])


def _rows(lang: str, part: str, told: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = [[lang] * len(told), [part] * len(told), *([t[k] for t in told] for k in range(3))]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == 4 else pa.string()) for k, c in enumerate(columns)], names=["lang", "part", "source", "item", "value"])


def _known(left: pa.Table, right: pa.Table) -> dict[str, dict]:
    """Groups of two blocks by language, as Language reads them."""
    out: dict[str, dict] = {}
    for side, table in (("left", left), ("right", right)):
        for row in table.to_pylist():
            lang = out.setdefault(row["lang"], {"kept": row["kept"], "total": row["lang_total"], "left": ([], [], row["kept"]), "right": ([], [], row["kept"])})
            lang[side][0].append(row["source"])
            lang[side][1].append(row["total"])
    return out


def _pass(kept: DataFrame, known: dict[str, dict], own: bool, top: int) -> DataFrame:
    """What two blocks of groups differ by, summed in each task."""
    sent = kept.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, name, held = sent.value, None, None
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            terms, lists, counts = (batch.column(c).to_pylist() for c in ("term", "sources", "counts"))
            low = 0
            while low < len(langs):
                high = low
                while high < len(langs) and langs[high] == langs[low]:
                    high += 1
                if langs[low] != name:
                    if held:
                        yield from held.rows(name)
                    name = langs[low]
                    held = Language(groups[name], own, top) if name in groups else None
                if held:
                    held.add(terms[low:high], lists[low:high], counts[low:high])
                low = high
        if held:
            yield from held.rows(name)

    return kept.select("lang", "term", "sources", "counts").mapInArrow(run, "lang string, part string, source string, item string, value long")


def divergences(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` holds a source against each other one of its language, ``term`` the ``top`` terms it has more of than its language."""
    spark = docs.sparkSession
    whole = merged(stripes(docs)).where((F.col("docs") >= least_docs) | (F.col("term") == ""))
    kept = materialize(whole, "stripes")
    counts = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("s")).groupBy("lang", F.col("s.sources").alias("source")).agg(F.sum("s.counts").alias("total"))
    counts = materialize(counts, "group-totals")
    of_lang = kept.groupBy("lang").agg(F.count_if(F.col("term") != "").alias("kept"))
    sums = counts.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.count("*").alias("n_sources"))
    groups = materialize(counts.join(of_lang, "lang").join(sums, "lang"), "groups")
    size = groups.agg(F.count("*").alias("n"), F.coalesce(F.max("n_sources"), F.lit(0)).alias("most")).first()
    by_lang, by_source = max(1, math.ceil(size["n"] / GROUPS)), max(1, math.ceil(size["most"] / SOURCES))
    lang_block = F.pmod(F.xxhash64("lang"), F.lit(by_lang))
    source_block = F.pmod(F.xxhash64("source"), F.lit(by_source))
    parts = []
    for block in range(by_lang):
        mine = groups.where(lang_block == block)
        for i in range(by_source):
            left = mine.where(source_block == i).toArrow()
            for j in range(by_source):
                right = left if i == j else mine.where(source_block == j).toArrow()
                parts.append(_pass(kept.where(lang_block == block), _known(left, right), i == j, top))
    found = materialize(reduce(DataFrame.unionByName, parts), "divergence-parts")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    terms = ranked(found.where("part = 'term'").select("lang", "source", "part", "item", "value")).where(F.col("rank") <= top)
    return ranked(pairs).unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
