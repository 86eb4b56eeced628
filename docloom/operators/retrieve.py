"""Top-k retrieval for a table of queries: vector, keyword, hybrid, approximate.

One scan of the corpus scores all queries. Inside a task a batch of items meets
a block of queries as arrays, and only each query's k best leave the task; the
shuffle carries k rows per query and task, never the query x item product.

How queries reach the tasks depends on their measured size. A batch within
``QUERY_LIMIT`` rows and ``QUERY_WEIGHT`` entries is broadcast. A larger batch is
written as blocks to the shared folder, and every task walks the blocks over its own
items, with the same result. Queries that ask for a tag only meet items of that tag.
"""

from __future__ import annotations

import json
import math
import urllib.parse
import uuid
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.functions import text as T
from docloom.session import materialize, scratch_folder

if TYPE_CHECKING:
    from docloom.operators.postings import StoredIndex

QUERY_LIMIT = 4096
QUERY_WEIGHT = 2_000_000
#: Items of a file of approximate search, and queries that a task holds while it walks these files.
CELL_ROWS, CELL_WEIGHT = 20_000, 20_000_000
PROBE_ROWS = 4096
#: Candidates that are gathered before they are merged with the best so far.
MERGE_ROWS = 20_000
#: Items that a task holds while it walks the blocks of a large query set.
WALK_ROWS, WALK_WEIGHT = 200_000, 10_000_000
MATRIX_CELLS = 4_000_000
#: Numbers in the rows that a task routes to their lists at once.
ROUTE_CELLS = 2_000_000
#: Bytes of centres that every task may hold.
CENTROID_BYTES = 256 << 20
#: Share of the true neighbours that approximate search is to find, and queries it is calibrated on.
RECALL, PROBE_QUERIES = 0.95, 256
DIGITS = 6

K1, B = 1.2, 0.75
FUSION_DEPTH, FUSION_OFFSET = 50, 60


def chunks_of(corpus: DataFrame | StoredIndex) -> DataFrame:
    """The rows of a corpus or of a stored index."""
    return corpus if isinstance(corpus, DataFrame) else corpus.chunks


# --------------------------------------------------------------- filters ----
def metadata_filter(spec: str | dict | None) -> Column:
    """``{"col": v}`` equality, ``{"col": [v, w]}`` membership, ``{"col LIKE": s}`` containment."""
    wanted = json.loads(spec) if isinstance(spec, str) else (spec or {})
    condition = F.lit(True)
    for key, value in wanted.items():
        name, _, operator = key.strip().partition(" ")
        if operator.strip().upper() == "LIKE":
            condition = condition & F.col(name).contains(str(value))
        elif operator:
            raise ValueError(f"unknown filter operator in {key!r}")
        elif isinstance(value, list):
            condition = condition & F.col(name).isin(value)
        else:
            condition = condition & (F.col(name) == F.lit(value))
    return condition


# ----------------------------------------------- scoring inside one task ----
def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list array as rows of a float matrix; NULL vectors become zero rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not len(vectors):
        return np.zeros((0, 0))
    widths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    width = int(widths.max())
    if width and not np.isin(widths, (0, width)).all():
        raise ValueError("vectors of different lengths")
    out = np.zeros((len(vectors), width))
    if width:
        flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
        out[widths == width] = flat.reshape(-1, width)
    return out


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _plain(values) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    found = values.to_numpy(zero_copy_only=False)
    return found.astype(str) if found.dtype == object else found


def _rounded(scores: np.ndarray) -> np.ndarray:
    """Half-up at ``DIGITS``, after the noise of the last binary digits is gone.

    Ranks are taken on rounded scores, so they do not depend on summation order.
    """
    clean = np.round(scores, 12)
    return np.copysign(np.floor(np.abs(clean) * 10**DIGITS + 0.5) / 10**DIGITS, clean) + 0.0


class _Cosine:
    """Cosine similarity of item vectors with a block of query vectors."""

    def __init__(self, queries: pa.Table):
        self.unit = _unit(_matrix(queries.column("q_payload")))

    def score(self, payload: pa.Array, some: np.ndarray | None = None) -> np.ndarray:
        """Scores of all queries of the block, or of ``some``."""
        items, unit = _unit(_matrix(payload)), self.unit if some is None else self.unit[some]
        scores = items @ unit.T if items.size and unit.size else np.zeros((len(payload), len(unit)))
        scores[~items.any(axis=1)] = -np.inf
        return scores


class _Bm25:
    """BM25 of item token arrays against a block of weighted query terms."""

    def __init__(self, queries: pa.Table, mean_length: float):
        payload = queries.column("q_payload").combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(payload), 0).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(payload)
        owner = np.repeat(np.arange(len(payload)), lengths)
        weights = pc.struct_field(flat, "idf").to_numpy(zero_copy_only=False)
        encoded = pc.struct_field(flat, "term").dictionary_encode()
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.combine_chunks()
        self.terms = encoded.dictionary
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        by_term = np.argsort(codes, kind="stable")
        self.owner = owner[by_term]
        self.starts = np.searchsorted(codes[by_term], np.arange(len(self.terms) + 1))
        self.idf = np.zeros(len(self.terms))
        self.idf[codes] = weights
        self.width = len(payload)
        self.mean_length = mean_length

    def score(self, payload: pa.Array) -> np.ndarray:
        rows = len(payload)
        scores = np.full((rows, self.width), -np.inf)
        if not len(self.terms) or not rows:
            return scores
        lengths = pc.fill_null(pc.list_value_length(payload), 0).to_numpy(zero_copy_only=False)
        found = pc.index_in(pc.list_flatten(payload), value_set=self.terms)
        known = pc.is_valid(found).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(rows), lengths)[known]
        term = found.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        pairs, counts = np.unique(row * len(self.terms) + term, return_counts=True)
        row, term = pairs // len(self.terms), pairs % len(self.terms)
        scale = K1 * (1 - B + B * lengths[row] / self.mean_length)
        weight = self.idf[term] * counts * (K1 + 1) / (counts + scale)
        fan = self.starts[term + 1] - self.starts[term]
        total = np.zeros(rows * self.width)
        # bounded slices: a word of every query fans out to the whole block
        for part in _slices(fan, MATRIX_CELLS):
            f = fan[part]
            offset = np.arange(f.sum()) - np.repeat(np.cumsum(f) - f, f)
            owner = self.owner[np.repeat(self.starts[term[part]], f) + offset]
            cells = np.repeat(row[part], f) * self.width + owner
            total += np.bincount(cells, weights=np.repeat(weight[part], f), minlength=len(total))
        total = total.reshape(rows, self.width)
        return np.where(total > 0, total, -np.inf)


def _slices(sizes: np.ndarray, budget: int) -> Iterator[slice]:
    """Consecutive slices whose sizes sum to about ``budget`` or less."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, base + budget, side="right")), start + 1)
        yield slice(start, stop)
        start = stop


class _Best:
    """Each query's k best items so far, ties to the smaller item id."""

    def __init__(self, queries: pa.Table, scorer, k: int, skip_same: bool):
        self.ids = _plain(queries.column("query_id"))
        self.scorer, self.k, self.skip_same = scorer, k, skip_same
        self.kept: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # to be merged with what is kept
        self.floor = np.full(len(self.ids), -np.inf)  # what the k-th best has at least

    def add(self, items, some: np.ndarray | None = None) -> None:
        """Items that all queries of the block meet, or ``some``."""
        step = max(1, MATRIX_CELLS // max(1, len(self.ids) if some is None else len(some)))
        for start in range(0, items.num_rows, step):
            self._add(items.slice(start, step), some)

    def _add(self, items, some: np.ndarray | None) -> None:
        payload = items.column("i_payload")
        if isinstance(payload, pa.ChunkedArray):
            payload = payload.combine_chunks()
        scores = self.scorer.score(payload) if some is None else self.scorer.score(payload, some)
        item_ids = _plain(items.column("item_id"))
        ids, floor = (self.ids, self.floor) if some is None else (self.ids[some], self.floor[some])
        if self.skip_same:
            scores[item_ids[:, None] == ids[None, :]] = -np.inf
        if len(scores) > self.k and np.isneginf(floor).any():
            floor = np.maximum(floor, _rounded(np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]))
        # rounding lifts a score by less than its last digit; only what may reach the floor is rounded
        row, query = np.nonzero((scores >= floor - 10.0**-DIGITS) & (scores > -np.inf))
        score = _rounded(scores[row, query])
        high = score >= floor[query]
        if high.any():
            row, query = row[high], query[high]
            self.found.append((query if some is None else some[query], item_ids[row], score[high]))
            if sum(len(part[0]) for part in self.found) >= max(MERGE_ROWS, self.k * len(self.ids)):
                self._merge()

    def _merge(self) -> None:
        parts = [*([self.kept] if self.kept is not None else []), *self.found]
        if not self.found:
            return
        found = tuple(np.concatenate(column) for column in zip(*parts, strict=True))
        order = np.lexsort((found[1], -found[2], found[0]))
        query, item, score = (part[order] for part in found)
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        self.floor[query[nth == self.k - 1]] = score[nth == self.k - 1]
        self.kept, self.found = (query[nth < self.k], item[nth < self.k], score[nth < self.k]), []

    def rows(self, schema: pa.Schema) -> pa.Table:
        self._merge()
        if self.kept is None:
            return schema.empty_table()
        query, item, score = self.kept
        columns = [pa.array(self.ids[query]), pa.array(item), pa.array(score)]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


class _BestByTag:
    """A block of queries by the tag they ask for: those without one meet all items, the others only those of their tag."""

    def __init__(self, queries: pa.Table, make_scorer, k: int, skip_same: bool):
        asked = queries.column("q_only")
        self.parts = {}
        for tag in asked.unique().to_pylist():
            own = queries.filter(pc.is_null(asked) if tag is None else pc.fill_null(pc.equal(asked, tag), False))
            self.parts[tag] = _Best(own, make_scorer(own), k, skip_same)

    def add(self, items) -> None:
        if None in self.parts:
            self.parts[None].add(items)
        if len(self.parts) == (None in self.parts):
            return
        tags = items.column("i_only")
        tags = (tags.combine_chunks() if isinstance(tags, pa.ChunkedArray) else tags).dictionary_encode()
        codes = pc.fill_null(tags.indices, -1).to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        edges = np.searchsorted(codes[order], np.arange(len(tags.dictionary) + 1))
        for code, tag in enumerate(tags.dictionary.to_pylist()):
            if tag in self.parts:
                self.parts[tag].add(items.take(pa.array(order[edges[code] : edges[code + 1]])))

    def rows(self, schema: pa.Schema) -> pa.Table:
        return pa.concat_tables([schema.empty_table(), *(part.rows(schema) for part in self.parts.values())])


# ------------------------------------------------------- the distributed part
def top_k_per_query(scored: DataFrame, k: int, query: str = "query_id", item: str = "item_id") -> DataFrame:
    """Rank and keep k rows per query; ranks are pruned before the shuffle."""
    order = Window.partitionBy(query).orderBy(F.desc("score"), F.asc(item))
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _arrow_schema(queries: DataFrame, corpus: DataFrame) -> tuple[st.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = st.StructType(
        [
            st.StructField("query_id", queries.schema["query_id"].dataType),
            st.StructField("item_id", corpus.schema["item_id"].dataType),
            st.StructField("score", st.DoubleType()),
        ]
    )
    return schema, to_arrow_schema(schema)


def _size(side: DataFrame, payload: str):
    """Rows and payload entries of one side."""
    entries = F.coalesce(F.sum(F.coalesce(F.size(payload), F.lit(0))), F.lit(0))
    return side.agg(F.count(F.lit(1)).alias("n"), entries.alias("w")).first()


def _score_all(queries: DataFrame, corpus: DataFrame, make_scorer, k: int, skip_same: bool) -> DataFrame:
    """k best candidates of each query per task (exact; rank them afterwards)."""
    schemas = _arrow_schema(queries, corpus)
    queries = materialize(queries, "queries")  # what is counted is what is read
    size = _size(queries, "q_payload")
    if size["n"] <= QUERY_LIMIT and size["w"] <= QUERY_WEIGHT:
        schema, arrow = schemas
        block = corpus.sparkSession.sparkContext.broadcast(queries.toArrow())

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = block.value
            if not table.num_rows:
                return
            best = _BestByTag(table, make_scorer, k, skip_same)
            for batch in batches:
                best.add(batch)
            yield from best.rows(arrow).to_batches()

        return corpus.mapInArrow(score, schema)
    return _walk(queries, max(math.ceil(size["n"] / QUERY_LIMIT), math.ceil(size["w"] / QUERY_WEIGHT)), corpus, make_scorer, k, skip_same, schemas)


def _walk(queries: DataFrame, blocks: int, corpus: DataFrame, make_scorer, k: int, skip_same: bool, schemas) -> DataFrame:
    """Queries as files in the shared folder; each task walks them over its own items, so the corpus isn't shuffled.

    A file holds neighbouring tags, and an item meets the queries of its own tag only. A task
    holds ``WALK_ROWS`` items or ``WALK_WEIGHT`` entries at once, and one file of queries.
    """
    schema, arrow = schemas
    folder = f"{scratch_folder(corpus.sparkSession)}/query-blocks-{uuid.uuid4().hex}"
    dealt = queries.repartitionByRange(blocks, F.col("q_only").asc_nulls_first(), "query_id")
    dealt.write.option("maxRecordsPerFile", QUERY_LIMIT).parquet(folder)
    names = sorted(urllib.parse.unquote(name) for name in corpus.sparkSession.read.parquet(folder).inputFiles())  # a name for each block

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for items in _held(batches):
            for name in names:
                files, path = pafs.FileSystem.from_uri(name)
                with files.open_input_file(path) as file:
                    block = pq.read_table(file)
                best = _BestByTag(block, make_scorer, k, skip_same)
                best.add(items)
                yield from best.rows(arrow).to_batches()

    return corpus.mapInArrow(score, schema)


def _held(batches: Iterator[pa.RecordBatch], payload: str = "i_payload", most: int | None = None) -> Iterator[pa.Table]:
    """Rows in tables of bounded size."""
    held: list[pa.RecordBatch] = []
    rows = weight = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        weight += pc.sum(pc.list_value_length(batch.column(payload))).as_py() or 0
        if rows >= (most or WALK_ROWS) or weight >= WALK_WEIGHT:
            yield pa.Table.from_batches(held)
            held, rows, weight = [], 0, 0
    if rows:
        yield pa.Table.from_batches(held)


def _query_side(queries: DataFrame, query_id: str, payload: Column, only: str | None) -> DataFrame:
    return queries.select(
        F.col(query_id).alias("query_id"),
        payload.alias("q_payload"),
        (F.col(only).cast("string") if only else F.lit(None).cast("string")).alias("q_only"),
    )


def _item_side(corpus: DataFrame, item_id: str, payload: Column, only: str | None) -> DataFrame:
    return corpus.select(
        F.col(item_id).alias("item_id"),
        payload.alias("i_payload"),
        (F.col(only).cast("string") if only else F.lit(None).cast("string")).alias("i_only"),
    )


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, *, query_id: str = "query_id",
                item_id: str = "chunk_id", query_vector: str = "vector", item_vector: str = "vector",
                filters: str | dict | None = None, query_only: str | None = None, item_only: str | None = None,
                skip_same: bool = False) -> DataFrame:
    """Exact cosine top-k: ``query_id, item_id, score, rank``.

    ``filters`` narrows the corpus before ranking; ``query_only``/``item_only``
    name columns that must agree where the query's is set. Vectors without
    direction (NULL or zero) match nothing.
    """
    items = corpus.where(metadata_filter(filters)) if filters else corpus
    scored = _score_all(
        _query_side(queries, query_id, F.col(query_vector), query_only),
        _item_side(items, item_id, F.col(item_vector), item_only),
        _Cosine, k, skip_same,
    )
    return top_k_per_query(scored, k)


def bm25_topk(queries: DataFrame, corpus: DataFrame | StoredIndex, k: int = 10, *, query_id: str = "query_id",
              item_id: str = "chunk_id", query_text: str = "question", item_text: str = "chunk_text",
              item_tokens: str | None = None, filters: str | dict | None = None, query_only: str | None = None,
              item_only: str | None = None) -> DataFrame:
    """BM25 top-k over distinct query terms: ``query_id, item_id, score, rank``.

    A stored index answers from its posting lists. A corpus without one is read as it is;
    ``item_tokens`` names a stored token array, so that it is not split again.

    The first pass counts the items holding each term; counts combine before
    they are shuffled and meet the query's terms, so a common word is one row a
    task. The number of items and their total length are an aggregate of their own.
    """
    if not isinstance(corpus, DataFrame):
        return corpus.keyword_topk(queries, k, query_id=query_id, query_text=query_text, filters=filters,
                                   query_only=query_only, item_only=item_only)
    items = corpus.where(metadata_filter(filters)) if filters else corpus
    split = F.col(item_tokens) if item_tokens else T.tokens(item_text)
    words = items.select(split.alias("_words"))
    asked = queries.select(
        F.col(query_id).alias("query_id"),
        F.explode(F.array_distinct(T.tokens(query_text))).alias("term"),
    )
    wanted = materialize(asked.select("term").distinct(), "query-terms")
    held = words.select(F.explode(F.array_distinct("_words")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counts = materialize(held.join(wanted, "term", "left_semi"), "term-counts")
    number, total = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_words")), F.lit(0))).first()
    mean_length = float(total) / number if number and total else 1.0
    idf = F.log(1 + (F.lit(float(number)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = (
        asked.join(counts.select("term", idf.alias("idf")), "term")
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("q_payload"))
    )
    only = queries.select(F.col(query_id).alias("query_id"),
                          (F.col(query_only).cast("string") if query_only else F.lit(None).cast("string")).alias("q_only"))
    scored = _score_all(
        weighted.join(only, "query_id"),
        _item_side(items, item_id, split, item_only),
        lambda block: _Bm25(block, mean_length), k, False,
    )
    return top_k_per_query(scored, k)


def fuse(first: DataFrame, second: DataFrame, k: int = 10) -> DataFrame:
    """Reciprocal-rank fusion of two rankings (rows ``query_id, item_id, rank``)."""
    weight = F.lit(1.0) / (FUSION_OFFSET + F.col("rank"))
    both = first.select("query_id", "item_id", weight.alias("w")).unionByName(
        second.select("query_id", "item_id", weight.alias("w"))
    )
    scored = both.groupBy("query_id", "item_id").agg(F.round(F.sum("w"), DIGITS).alias("score"))
    return top_k_per_query(scored, k)


def hybrid_topk(queries: DataFrame, corpus: DataFrame | StoredIndex, k: int = 10, *, query_id: str = "query_id",
                item_id: str = "chunk_id", query_text: str = "question", item_text: str = "chunk_text",
                query_vector: str = "vector", item_vector: str = "vector", item_tokens: str | None = None,
                filters: str | dict | None = None, query_only: str | None = None,
                item_only: str | None = None) -> DataFrame:
    """Semantic and keyword ranking fused: the top ``FUSION_DEPTH`` of each compete."""
    shared = dict(query_id=query_id, item_id=item_id, filters=filters, query_only=query_only, item_only=item_only)
    depth = max(FUSION_DEPTH, k)
    by_meaning = vector_topk(queries, chunks_of(corpus), depth, query_vector=query_vector, item_vector=item_vector, **shared)
    by_words = bm25_topk(queries, corpus, depth, query_text=query_text, item_text=item_text,
                         item_tokens=item_tokens, **shared)
    return fuse(by_meaning, by_words, k)


# -------------------------------------------------------------- approximate --
def train_centroids(corpus: DataFrame, vector: str = "vector", lists: int | None = None, iterations: int = 8,
                    seed: int = 7) -> np.ndarray:
    """Centres of ``lists`` direction clusters (by default about the square root of the corpus).

    ``lists`` is taken as given. Centres beyond ``CENTROID_BYTES``, which every
    task would hold, are an error. Keep the result to search the same corpus again.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.functions import vector_to_array as array_of

    rows = corpus.where(F.exists(vector, lambda x: x != 0)).select(
        array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    )
    rows = materialize(rows, "training")  # every iteration reads it
    lists = lists or math.ceil(math.sqrt(rows.count()))
    longest = rows.agg(F.max(F.size(array_of("features")))).first()[0] or 0
    if lists * longest * 8 > CENTROID_BYTES:
        raise ValueError(f"{lists} centres of {longest} dimensions exceed CENTROID_BYTES; ask for fewer lists")
    if lists < 2:
        return np.zeros((1, 1))
    model = KMeans(k=lists, seed=seed, maxIter=iterations, distanceMeasure="cosine").fit(rows)
    return np.array(model.clusterCenters())


def _routed(df: DataFrame, vector: str, centroids, probes: int) -> DataFrame:
    """One row per vector and each of its ``probes`` nearest lists."""
    schema = st.StructType(df.schema.fields + [st.StructField("list", st.IntegerType())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = _unit(centroids.value)
        reach = min(probes, len(centres))
        for batch in batches:
            matrix = _matrix(batch.column(batch.schema.get_field_index(vector)))
            rows = np.flatnonzero(matrix.any(axis=1))
            if not len(rows):
                continue
            # copies, scores and places of some rows at a time, however many lists there are
            for part in _slices(np.full(len(rows), len(centres) + reach * matrix.shape[1]), ROUTE_CELLS):
                some = rows[part]
                if len(centres) == 1:
                    near = np.zeros((len(some), 1), dtype=np.int32)
                else:
                    near = np.argpartition(-(matrix[some] @ centres.T), reach - 1, axis=1)[:, :reach].astype(np.int32)
                out = batch.take(pa.array(np.repeat(some, near.shape[1])))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(near.ravel())], names=schema.names)

    return df.mapInArrow(route, schema)


def probes_for(recall: float, queries: DataFrame, items: DataFrame, k: int, centroids: np.ndarray, *, query_id: str,
               item_id: str, query_vector: str, item_vector: str, skip_same: bool = False) -> int:
    """Fewest lists that hold ``recall`` of the true neighbours of ``PROBE_QUERIES`` queries, found by one exact scan."""
    some = queries.where(F.exists(query_vector, lambda x: x != 0)).select(query_id, query_vector)
    some = materialize(some.orderBy(F.xxhash64(query_id)).limit(PROBE_QUERIES), "probe-queries")
    truth = materialize(vector_topk(some, items, k, query_id=query_id, item_id=item_id, query_vector=query_vector,
                                    item_vector=item_vector, skip_same=skip_same).select("query_id", "item_id"), "probe-truth")
    asked = some.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("q"))
    stored = items.select(F.col(item_id).alias("item_id"), F.col(item_vector).alias("i"))
    shared = items.sparkSession.sparkContext.broadcast(centroids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = _unit(shared.value)
        for batch in batches:
            if batch.num_rows:
                near, home = (_matrix(batch.column(c)) @ centres.T for c in "qi")
                at = near[np.arange(len(near)), home.argmax(axis=1)]
                yield pa.RecordBatch.from_arrays([pa.array((near >= at[:, None]).sum(axis=1), pa.int32())], names=["place"])

    if len(centroids) == 1:
        return 1
    found = truth.join(asked, "query_id").join(stored, "item_id").select("q", "i").mapInArrow(place, "place int")
    counts = sorted((r["place"], r["count"]) for r in found.groupBy("place").count().collect())  # at most a row per list
    wanted, seen = recall * sum(n for _, n in counts), 0
    for place_no, n in counts:
        seen += n
        if seen >= wanted:
            return place_no
    return len(centroids)


def ann_topk(queries: DataFrame, corpus: DataFrame, k: int = 10, *, query_id: str = "query_id",
             item_id: str = "chunk_id", query_vector: str = "vector", item_vector: str = "vector",
             filters: str | dict | None = None, centroids: np.ndarray | None = None, probes: int | None = None,
             skip_same: bool = False, recall: float = RECALL) -> DataFrame:
    """Approximate cosine top-k: exact scores within the ``probes`` nearest lists of each query.

    Without ``probes``, as many as hold ``recall`` of the true neighbours of a sample
    of the queries in this corpus, so the share of lists follows the data and its size.

    Every item is in the list of its nearest centre. A list is only a routing key:
    queries are dealt over tasks whatever they probe, and a list holding a third of
    the corpus becomes many bounded files instead of one long task.
    """
    items = corpus.where(metadata_filter(filters)) if filters else corpus
    asked = _query_side(queries, query_id, F.col(query_vector), None)
    stored = _item_side(items, item_id, F.col(item_vector), None)
    if centroids is None:
        centroids = train_centroids(items, item_vector)
    if probes is None:
        probes = probes_for(recall, queries, items, k, centroids, query_id=query_id, item_id=item_id,
                            query_vector=query_vector, item_vector=item_vector, skip_same=skip_same)
    return top_k_per_query(_walk_lists(asked, stored, centroids, probes, k, skip_same), k)


def _walk_lists(asked: DataFrame, stored: DataFrame, centroids: np.ndarray, probes: int, k: int, skip_same: bool) -> DataFrame:
    """k best items of each query within its ``probes`` nearest lists: no row is copied for a list, and k rows a query come out.

    Few queries are broadcast, as in exact search. Beyond that items are stored once, in files of neighbouring lists,
    and queries are dealt out once: a task walks the files over the queries it holds, each list meeting those that probe it.
    """
    schema, arrow = _arrow_schema(asked, stored)
    spark = stored.sparkSession
    shared = spark.sparkContext.broadcast(centroids)
    items = materialize(_routed(stored, "i_payload", shared, 1), "routed-items")
    queries = materialize(asked, "queries")  # what is counted is what is read
    size, asks = _size(items, "i_payload"), _size(queries, "q_payload")

    def scored(block: pa.Table, parts: Iterator[pa.Table]) -> Iterator[pa.RecordBatch]:
        block = block.filter(pa.array(_matrix(block.column("q_payload")).any(axis=1), pa.bool_()))  # the others match nothing
        if not block.num_rows:
            return
        best = _Best(block, _Cosine(block), k, skip_same)
        bits = _probed(best.scorer.unit, _unit(shared.value), probes)
        for part in parts:
            if bits is None:
                best.add(part)
                continue
            part = part.sort_by("list")
            number = part.column("list").to_numpy()
            for low, high in _runs_of(number):
                wanted = np.flatnonzero(bits[:, number[low] >> 3] & (128 >> (number[low] & 7)))
                if len(wanted):
                    best.add(part.slice(low, high - low), wanted)
        yield from best.rows(arrow).to_batches()

    if asks["n"] <= QUERY_LIMIT and asks["w"] <= QUERY_WEIGHT:
        sent = spark.sparkContext.broadcast(queries.toArrow())

        def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from scored(sent.value, (pa.Table.from_batches([batch]) for batch in batches))

        return items.mapInArrow(few, schema)
    folder = f"{scratch_folder(spark)}/list-blocks-{uuid.uuid4().hex}"
    files = max(1, math.ceil(size["n"] / CELL_ROWS), math.ceil(size["w"] / CELL_WEIGHT))
    # a list that is longer than a file goes on in the next
    items.repartitionByRange(files, "list", "item_id").write.option("maxRecordsPerFile", CELL_ROWS).parquet(folder)
    names = sorted(urllib.parse.unquote(name) for name in spark.read.schema(items.schema).parquet(folder).inputFiles())  # a name for each file

    def read(name: str) -> pa.Table:
        opened, path = pafs.FileSystem.from_uri(name)
        with opened.open_input_file(path) as file:
            return pq.read_table(file)

    def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _held(batches, "q_payload", PROBE_ROWS):
            yield from scored(block, map(read, names))

    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(asks["n"] / PROBE_ROWS), math.ceil(asks["w"] / WALK_WEIGHT))
    return queries.repartition(tasks).mapInArrow(many, schema)


def _probed(unit: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray | None:
    """A bit for each vector and list, set for its nearest ``probes`` lists; None where all are."""
    if probes >= len(centres):
        return None
    bits = np.zeros((len(unit), (len(centres) + 7) // 8), np.uint8)
    for part in _slices(np.full(len(unit), len(centres)), ROUTE_CELLS):
        near = np.zeros((len(unit[part]), len(centres)), bool)
        if near.size and unit.shape[1]:
            best = np.argpartition(-(unit[part] @ centres.T), probes - 1, axis=1)[:, :probes]
            near[np.arange(len(near))[:, None], best] = True
        bits[part] = np.packbits(near, axis=1)
    return bits


def _runs_of(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal neighbours begin and end."""
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, int)
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


# --------------------------------------------------------------- one front --
QUERY_TYPES = ["ANN", "HYBRID", "FULL_TEXT"]


def search(queries: DataFrame, index: DataFrame | StoredIndex, columns: list[str], num_results: int = 10, query_type: str = "ANN",
           filters: str | dict | None = None, *, item_id: str = "chunk_id", centroids: np.ndarray | None = None,
           **names) -> DataFrame:
    """Requested columns of each query's best items, score last.

    ``ANN`` ranks by meaning (through ``centroids`` when given, exactly
    otherwise), ``FULL_TEXT`` by words, ``HYBRID`` by both.
    """
    if query_type == "ANN" and centroids is not None:
        ranking = ann_topk(queries, chunks_of(index), num_results, item_id=item_id, filters=filters, centroids=centroids, **names)
    elif query_type == "ANN":
        ranking = vector_topk(queries, chunks_of(index), num_results, item_id=item_id, filters=filters, **names)
    elif query_type == "FULL_TEXT":
        ranking = bm25_topk(queries, index, num_results, item_id=item_id, filters=filters, **names)
    elif query_type == "HYBRID":
        ranking = hybrid_topk(queries, index, num_results, item_id=item_id, filters=filters, **names)
    else:
        raise ValueError(f"query_type must be one of {QUERY_TYPES}")
    return with_columns(ranking, chunks_of(index), columns, item_id)


# ----------------------------------------------------- reading the rankings --
def with_columns(ranking: DataFrame, corpus: DataFrame, columns: list[str], item_id: str = "chunk_id") -> DataFrame:
    """Requested item columns next to a ranking, the score last.

    The ranking is stored first: its size is then known to the planner, which
    broadcasts it while it is small instead of shuffling the corpus.
    """
    ranking = materialize(ranking, "ranking")
    picked = corpus.select(F.col(item_id).alias("item_id"), *columns)
    return ranking.join(picked, "item_id").select("query_id", "rank", "item_id", *columns, "score")


def compare_rankings(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both ranks of every item that either ranking returned."""
    a = left.select("query_id", "item_id", F.col("rank").alias("left_rank"))
    b = right.select("query_id", "item_id", F.col("rank").alias("right_rank"))
    return a.join(b, ["query_id", "item_id"], "full_outer")


def citations(ranking: DataFrame, source: str = "source_path") -> DataFrame:
    """Distinct sources behind each query's result with their best rank."""
    return ranking.groupBy("query_id", source).agg(F.min("rank").alias("best_rank"))


def retrieval_eval(ranking: DataFrame, truth: DataFrame, k: int = 10) -> DataFrame:
    """hit@k and mean reciprocal rank over the queries that have a known answer.

    ``truth`` rows are ``(query_id, item_id)``.
    """
    seen = ranking.where(F.col("rank") <= k).select("query_id", "item_id", "rank")
    return (
        truth.select("query_id", "item_id").join(seen, ["query_id", "item_id"], "left")
        .groupBy("query_id").agg(F.min("rank").alias("first_rank"))
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.count("first_rank").alias("hits"),
            F.round(F.avg(F.when(F.col("first_rank").isNotNull(), 1.0).otherwise(0.0)), DIGITS).alias("hit_rate"),
            F.round(F.avg(F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0))), DIGITS).alias("mrr"),
        )
    )


def verbatim_hits(passages: DataFrame, corpus: DataFrame, *, passage_id: str = "query_id", passage: str = "question",
                  item_id: str = "chunk_id", text: str = "chunk_text", width: int = 8) -> DataFrame:
    """``(query_id, item_id)`` pairs where the item holds the passage word for word.

    An equi-join on the hash of the passage's first run of up to ``width`` words
    finds the candidates; the whole word sequence then settles them. The long
    texts are joined back to the candidate pairs only, not carried along with
    every run.
    """
    asked = passages.select(F.col(passage_id).alias("query_id"), T.tokens(passage).alias("_p")).where(F.size("_p") > 0)
    asked = asked.select(
        "query_id",
        F.least(F.lit(width), F.size("_p")).alias("_width"),
        F.xxhash64(F.slice("_p", F.lit(1), F.least(F.lit(width), F.size("_p")))).alias("_run"),
        F.array_join("_p", " ").alias("_passage"),
    )
    items = corpus.select(F.col(item_id).alias("item_id"), T.tokens(text).alias("_words"))
    widths = [row["_width"] for row in asked.select("_width").distinct().collect()]  # at most `width` values

    def runs(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("_words") - (size - 1))
        run = F.transform(starts, lambda i: F.xxhash64(F.slice("_words", i, size)))
        return F.when(F.size("_words") >= size, run).otherwise(F.array().cast("array<bigint>"))

    every_run = F.concat(*[runs(size) for size in sorted(widths)]) if widths else F.array().cast("array<bigint>")
    pairs = items.select("item_id", F.explode(F.array_distinct(every_run)).alias("_run")).join(asked, "_run")
    pairs = materialize(pairs.select("query_id", "item_id", "_passage"), "candidates")
    settled = F.contains(_worded(F.array_join("_words", " ")), _worded(F.col("_passage")))
    return items.join(pairs, "item_id").where(settled).select("query_id", "item_id")


def _worded(joined: Column) -> Column:
    return F.concat(F.lit(" "), joined, F.lit(" "))
