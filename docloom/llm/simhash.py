"""Near-duplicate documents by SimHash and a Gray-ordered hierarchical index.

A fingerprint has 64 bits; a bit is set if more than half of the text's word
shingles have it set in their hash. Equal fingerprints are one class. Classes link
at ``distance`` differing bits or fewer.

Search: with the bits in ``blocks`` groups, two fingerprints that differ in at most
d bits agree in at least ``blocks`` - d groups, so they meet under a key of that many
groups. More groups are taken for more fingerprints, so a key's rows stay few on
average; keys that still hold more than ``HOT_ROWS`` are split again, by the same rule
on the bits outside the key. No rule leaves a pair out.

With ``second``, each text has a fingerprint of 64 more bits. A pair then links if one of
the two differs in at most ``distance`` bits and the other in at most ``second``: the wider
one turns away texts that are near by chance, and both are searched.

Within a key the fingerprints are sorted by Gray rank, in which neighbours share
bits. Groups of ``FAN`` neighbours make nodes, groups of nodes the next level: a node
keeps the bits that all below it share and that its parent hasn't taken. A search
goes down the levels adding up the differences on these bits and leaves a whole
group out once they exceed the distance.

What a key finds leaves it as one link from each fingerprint to the smallest of its
group there, so a large group of copies sends one row each, not a row per pair.

Edge cases: NULL, empty and blank texts have fingerprint zero and link to each other
like any other; repeated rows are one class; a NULL doc_id never names a component
unless nothing else is in it; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.llm.arrays import by_text, mix
from docloom.llm.components import components
from docloom.session import materialize

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Rows that a key holds on average at most, and beyond which a key is split again.
MEAN_ROWS, HOT_ROWS = 2_000, 50_000
#: Bits that a key has at least: fewer give too few keys to spread over many tasks.
LEAST_BITS = 10
FAN, LEVELS = 16, 3
#: (query, node) pairs looked at together.
FRONT = 1 << 20
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# --------------------------------------------------------- fingerprints -----
def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's word shingles in order, of all its words if they are fewer; words are what lies between ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    return np.array([digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[shingle - 1 :])], np.uint64)


def fingerprints(texts: list[str | None], shingle: int = SHINGLE, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of each text, and one of other bits (zero unless asked for)."""
    spread = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")).view(np.uint64).ravel()
    out = np.zeros((2, len(texts)), np.uint64)
    for k, text in enumerate(texts):
        hashes = shingle_hashes(text, shingle)
        if not len(hashes):
            continue
        out[0, k] = majority(hashes, spread)
        if second:
            out[1, k] = majority(mix(hashes), spread)
    return out[0], out[1]


def majority(hashes: np.ndarray, spread: np.ndarray) -> np.uint64:
    """The bits that more than half of the hashes have: eight counters in a word, up to 255 hashes at a time."""
    raw = hashes.view(np.uint8).reshape(-1, 8)
    starts = np.arange(0, len(raw), 255)
    counts = np.stack([np.add.reduceat(spread[raw[:, byte]], starts).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64) for byte in range(8)])
    return np.packbits((counts.ravel() * 2 > len(raw)), bitorder="little").view(np.uint64)[0]


def with_fingerprint(docs: DataFrame, keep: list[str] | None = None, shingle: int = SHINGLE, second: bool = False) -> DataFrame:
    """Add ``simhash`` and ``simhash2`` (the bits as signed longs); columns of these names are replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("simhash", "simhash2")]

    def work() -> Callable[[pa.RecordBatch], list[pa.Array]]:
        return lambda batch: [pa.array(x.view(np.int64)) for x in fingerprints(batch.column("text").to_pylist(), shingle, second)]

    return by_text(docs, work, [("simhash", st.LongType()), ("simhash2", st.LongType())], keep)


# ---------------------------------------------------------- the index -------
def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Levels of nodes over codes that are sorted by (group, Gray rank); nodes don't cross groups."""

    def __init__(self, codes: np.ndarray, group: np.ndarray, distance: int = DISTANCE) -> None:
        self.codes, self.distance = codes, distance
        level = {"bits": codes, "mask": np.full(len(codes), ~np.uint64(0)), "group": group}
        self.levels = [level]
        for _ in range(LEVELS):
            level = self._above(level)
            self.levels.append(level)
        for low, high in zip(self.levels[:-1], self.levels[1:], strict=True):
            # a node keeps the shared bits that its parent hasn't taken
            low["own"] = low["mask"] & ~np.repeat(high["mask"], np.diff(high["first"]))
        self.levels[-1]["own"] = self.levels[-1]["mask"]

    @staticmethod
    def _above(level: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        group = level["group"]
        change = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        within = np.arange(len(group)) - np.repeat(change, np.diff(np.append(change, len(group))))
        starts = np.flatnonzero(within % FAN == 0)
        known, bits = level["mask"], level["bits"]
        ones, zeros = np.bitwise_and.reduceat(bits & known, starts), np.bitwise_and.reduceat(~bits & known, starts)
        return {"bits": ones, "mask": ones | zeros, "group": group[starts], "first": np.append(starts, len(group))}

    def pairs(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, found) at the distance or nearer, found after query, for the queries low..high."""
        top = self.levels[-1]
        begin = np.searchsorted(top["group"], self.levels[0]["group"][low:high], side="left")
        end = np.searchsorted(top["group"], self.levels[0]["group"][low:high], side="right")
        query, node = spread_out(np.arange(low, high), begin, end)
        stack = [(LEVELS, query, node, np.zeros(len(query), np.uint8))]
        while stack:
            depth, query, node, gone = stack.pop()
            if len(query) > FRONT:
                stack += [(depth, query[k : k + FRONT], node[k : k + FRONT], gone[k : k + FRONT]) for k in range(0, len(query), FRONT)]
                continue
            level = self.levels[depth]
            gone = gone + np.bitwise_count((self.codes[query] ^ level["bits"][node]) & level["own"][node])
            near = gone <= self.distance
            query, node, gone = query[near], node[near], gone[near]
            if not depth:
                later = node > query
                yield query[later], node[later]
            elif len(query):
                first = level["first"]
                wide = np.diff(first)[node]
                kept = np.repeat(np.arange(len(query)), wide)
                _, child = spread_out(query, first[node], first[node + 1])
                stack.append((depth - 1, query[kept], child, gone[kept]))


def spread_out(of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each ``of`` with every number of its range begin..end."""
    size = end - begin
    return np.repeat(of, size), np.arange(int(size.sum())) + np.repeat(begin - np.cumsum(size) + size, size)


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let the labels of linked places become the smallest of their group, in place."""
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label[label], label):
            label[:] = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]


def links_of(cid: np.ndarray, code: np.ndarray, other: np.ndarray, group: np.ndarray, distance: int = DISTANCE, second: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links (cid, first of its group there) that connect all classes of a key that are near."""
    order = np.lexsort((gray_rank(code), group))
    cid, code, other, group = cid[order], code[order], other[order], group[order]
    index, label = GrayIndex(code, group, distance), np.arange(len(code))
    for low in range(0, len(code), 1 << 14):
        for a, b in index.pairs(low, min(low + (1 << 14), len(code))):
            near = np.bitwise_count(other[a] ^ other[b]) <= second
            join_labels(label, a[near], b[near])
    moved = label != np.arange(len(code))
    return cid[moved], cid[label[moved]]


# ------------------------------------------------------------- the join -----
def block_count(n: int, distance: int, bits: int = 64) -> int:
    """Fewest groups of bits for which a key has bits enough to spread and its rows are few on average."""
    for blocks in range(distance + 1, distance + 5):
        width = bits * (blocks - distance) / blocks
        if width >= LEAST_BITS and n <= MEAN_ROWS * 2.0**width:
            break
    return blocks


def key_masks(bits: list[int], blocks: int, distance: int) -> list[int]:
    """Bit masks of all keys: every choice of ``blocks`` - ``distance`` groups of these bit numbers."""
    groups = [bits[len(bits) * k // blocks : len(bits) * (k + 1) // blocks] for k in range(blocks)]
    return [sum(1 << b for g in chosen for b in g) for chosen in itertools.combinations(groups, blocks - distance)]


def signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


def keyed(masks: list[int]) -> Column:
    """A row for each of these keys."""
    return F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask")


def links(classes: DataFrame, distance: int = DISTANCE, second: int = 0) -> DataFrame:
    """Links (a, b) that connect all near classes (columns cid, simhash, simhash2; the last is zero without ``second``)."""
    found = _links(classes, distance, second)
    if second:
        swapped = classes.select("cid", F.col("simhash2").alias("simhash"), F.col("simhash").alias("simhash2"))
        found = found.unionByName(_links(swapped, distance, second))
    return found


def _links(classes: DataFrame, distance: int, second: int) -> DataFrame:
    blocks = block_count(classes.count(), distance)
    part = F.col("simhash").bitwiseAND(F.col("mask")).alias("part")
    columns = ["cid", "simhash", "simhash2"]
    rows = classes.select(*columns, keyed(key_masks(list(range(64)), blocks, distance))).select(*columns, "mask", part)
    key = F.xxhash64("mask", "part").alias("key")
    hot = materialize(rows.groupBy("mask", "part").count().where(F.col("count") > HOT_ROWS).select("mask", "part"), "hot-keys")
    dealt = rows.select(*columns, key)
    if hot.head(1):
        again = rows.join(hot, ["mask", "part"]).withColumnsRenamed({"mask": "mask1", "part": "part1"})
        dealt = rows.join(hot, ["mask", "part"], "left_anti").select(*columns, key)
        for mask in [r["mask"] for r in hot.select("mask").distinct().collect()]:  # at most one row per choice of groups
            free = [b for b in range(64) if not (mask >> b) & 1]
            split = again.where(F.col("mask1") == mask).select(*columns, "mask1", "part1", keyed(key_masks(free, distance + 2, distance)))
            dealt = dealt.unionByName(split.select(*columns, F.xxhash64("mask1", "part1", "mask", part).alias("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cid, code, other, group in whole_keys(batches, [*columns, "key"]):
            a, b = links_of(cid, code.view(np.uint64), other.view(np.uint64), group, distance, second)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def whole_keys(batches: Iterator[pa.RecordBatch], columns: list[str], rows: int = 400_000) -> Iterator[list[np.ndarray]]:
    """Columns of about ``rows`` rows that never cut a key, the last column; rows come sorted by it."""
    held: list[list[np.ndarray]] = []
    count = 0
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
        count += batch.num_rows
        if count >= rows:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(whole[-1], whole[-1][-1], side="left"))
            if cut:
                yield [x[:cut] for x in whole]
            held, count = [[x[cut:] for x in whole]], count - cut
    if count:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, second: int = 0, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows (doc_id, keys, simhash, component, component_id) for every document.

    ``component_id`` is the smallest doc_id reachable over links, its own included;
    ``component`` names the group itself, which differs from any other group's.
    """
    prints = materialize(with_fingerprint(docs.select("doc_id", "text", *keys), ["doc_id", *keys], shingle, bool(second)), "fingerprints")
    grouped = prints.groupBy("simhash", "simhash2").agg(F.min("doc_id").alias("least"))
    classes = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = components(links(classes, distance, second)).select(F.col("node").alias("cid"), "label")
    named = classes.join(groups, "cid", "left").withColumn("component", F.coalesce("label", "cid"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(least, "component").select("simhash", "simhash2", "component", "component_id")
    return prints.join(found, ["simhash", "simhash2"]).select("doc_id", *keys, "simhash", "component", "component_id")


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
