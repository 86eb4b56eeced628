"""Near-duplicate vectors by collision counting over sorted one-dimensional projections.

Each of m projections sorts the vectors by their product with a random direction,
within the cells of ``k`` random hyperplanes of that projection's own. Around each
vector as a query lies a window of the sorted values; a vector in it collides. Pairs
are counted over all projections, and those with enough collisions are verified by
their cosine in double precision.

The cells keep a window's rows few as the table grows: without them every window
would hold a fixed share of all rows, and counting would be quadratic. ``calibrate``
chooses k from the number of vectors, and m and the count so that a pair right at
the threshold is found with probability ``RECALL``; closer pairs are surer.

Equal vectors are one class and enter once; links between classes count for all
members. Cells are cut into slabs of values, so that a crowded one is spread; vectors
of different lengths never share a cell.

Edge cases: vectors that are NULL, empty or zero, or hold a NULL or non-finite
component, link with nothing and are components of their own; repeated rows are
vectors of one class; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import compute_once
from docloom.llm.components import components
from docloom.session import materialize

COSINE, RECALL, SEED = 0.9, 0.97, 11
#: Rows that a cell holds on average; the window's half width; collisions that a pair needs.
CELL_ROWS, WINDOW, COUNT = 32, 0.7, 2
#: A slab's width in windows: the share of rows that are sent to two slabs is one in this.
SLAB = 4
#: Rows and pairs handled at once in a task.
ROWS, PAIRS = 200_000, 1 << 20


def calibrate(n: int, cosine: float = COSINE, recall: float = RECALL, count: int = COUNT) -> tuple[int, int]:
    """(hyperplanes a projection, projections) for n vectors."""
    planes = max(0, round(math.log2(max(n, 1) / CELL_ROWS)))
    apart = math.sqrt(max(2 - 2 * cosine, 1e-12))
    chance = (1 - math.acos(min(cosine, 1.0)) / math.pi) ** planes * math.erf(WINDOW / (math.sqrt(2) * apart))
    projections = count
    while sum(math.comb(projections, k) * chance**k * (1 - chance) ** (projections - k) for k in range(count)) > 1 - recall:
        projections += 1
    return planes, projections


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def with_unit(df: DataFrame, vector: str) -> DataFrame:
    """Add ``unit``, the vector at length one; scaled by its largest part first, so that squares neither overflow nor vanish.

    Each step is a column of its own: inside a lambda an expression would be computed anew for every part.
    """
    df = compute_once(df, __largest=F.aggregate(vector, F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x))))
    df = compute_once(df, __scaled=F.transform(vector, lambda x: x / F.col("__largest")))
    df = compute_once(df, __length=F.sqrt(F.aggregate("__scaled", F.lit(0.0), lambda s, x: s + x * x)))
    return compute_once(df, unit=F.transform("__scaled", lambda x: x / F.col("__length"))).drop("__largest", "__scaled", "__length")


def projected(classes: DataFrame, planes: int, projections: int) -> DataFrame:
    """Rows (cell, slab, value, own, cid): every class under every projection; ``own`` is false in the slab before its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for whole in batches:
            for low in range(0, whole.num_rows, 2000):
                batch = whole.slice(low, 2000)
                lists = batch.column("unit")
                sizes = np.diff(lists.offsets.to_numpy())
                flat = lists.values.to_numpy(zero_copy_only=False)[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
                cids = batch.column("cid").to_numpy(zero_copy_only=False)
                starts = np.cumsum(sizes) - sizes
                for size in np.unique(sizes).tolist():
                    if size not in directions:
                        directions[size] = np.random.default_rng([SEED, size]).standard_normal((size, projections * (planes + 1)))
                    rows = np.flatnonzero(sizes == size)
                    found = (flat[starts[rows][:, None] + np.arange(size)] @ directions[size]).reshape(len(rows), projections, planes + 1)
                    bits = (found[:, :, 1:] > 0) @ (1 << np.arange(planes, dtype=np.int64)) if planes else np.zeros(found.shape[:2], np.int64)
                    cell = ((np.int64(size) * projections + np.arange(projections)) << planes) + bits
                    value = found[:, :, 0].ravel()
                    slab = np.floor(value / (SLAB * WINDOW)).astype(np.int64)
                    near = np.floor((value - WINDOW) / (SLAB * WINDOW)).astype(np.int64)  # where rows just below it lie
                    cid = np.repeat(cids[rows], projections)
                    again = near < slab
                    columns = [(cell.ravel(), slab, value, np.ones(len(value), bool), cid), (cell.ravel()[again], near[again], value[again], np.zeros(again.sum(), bool), cid[again])]
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*columns, strict=True)], names=["cell", "slab", "value", "own", "cid"])

    return classes.select("cid", "unit").mapInArrow(run, "cell long, slab long, value double, own boolean, cid long")


def collisions(rows: DataFrame) -> DataFrame:
    """Pairs (a < b) for every window they share, each once a projection."""
    dealt = rows.select(F.xxhash64("cell", "slab").alias("key"), "value", "own", "cid").repartition("key").sortWithinPartitions("key", "value", "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        for whole in batches:
            for low in range(0, whole.num_rows, ROWS):
                new = [whole.column(c).slice(low, ROWS).to_numpy(zero_copy_only=False) for c in ("key", "value", "own", "cid")]
                first = 0
                if held is not None:
                    first = len(held[0])
                    new = [np.concatenate(x) for x in zip(held, new, strict=True)]
                key, value, own, cid = new
                yield from pairs(key, value, own.astype(bool), cid, first)
                kept = (key == key[-1]) & (value >= value[-1] - WINDOW)
                held = tuple(x[kept] for x in new)

    def pairs(key: np.ndarray, value: np.ndarray, own: np.ndarray, cid: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
        """Each row from ``first`` on as the upper end of a window over the rows before it, the lower end in its own slab."""
        place = np.arange(len(key))
        change = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(change, place, 0))
        span = value.max() - value.min() + 2 * WINDOW + 1
        line = np.cumsum(change) * span + (value - value.min())  # one sorted line for all keys
        begin = np.maximum(np.searchsorted(line, line - WINDOW, side="left"), group)
        size = np.where(place >= first, place - begin, 0)
        ends = np.cumsum(size)
        low = 0
        while low < len(key):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, side="right")))
            many = size[low:high]
            upper = np.repeat(place[low:high], many)
            lower = np.repeat(begin[low:high] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            kept = own[lower]
            a, b = cid[lower[kept]], cid[upper[kept]]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            low = high

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for every vector (columns vec_id, embedding)."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.when(usable(F.col("embedding")), F.col("embedding")))
    grouped = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = materialize(with_unit(grouped.withColumn("cid", F.monotonically_increasing_id()), "embedding"), "vector-classes")
    planes, projections = calibrate(classes.count(), cosine, recall)
    counted = collisions(projected(classes, planes, projections)).groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= COUNT)
    units = classes.select("cid", "unit")
    both = counted.select("a", "b").join(units.toDF("a", "ua"), "a").join(units.toDF("b", "ub"), "b")
    dot = F.aggregate(F.zip_with("ua", "ub", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = materialize(both.where(dot >= cosine).select("a", "b"), "vector-links")
    sizes = classes.select("cid", "n")
    ends = links.union(links.select("b", "a")).join(sizes.toDF("b", "n_b"), "b").groupBy("a").agg(F.sum("n_b").alias("n_other"))
    named = classes.select("cid", "embedding", "least", "n").join(ends.withColumnRenamed("a", "cid"), "cid", "left").join(components(links).withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("label", F.struct(F.col("label").isNull().alias("alone"), F.coalesce("label", "cid").alias("of")))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    told = named.join(least, "label").select("embedding", (F.col("n") - 1 + F.coalesce("n_other", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where("embedding IS NOT NULL").join(told, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("embedding IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
