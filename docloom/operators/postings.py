"""The stored search index: chunks and inverted lists in buckets of their keys, and keyword search on the lists.

A bucket is a hash of the item's key and holds about ``BUCKET_ITEMS`` items, numbered in key
order. It is a small inverted index of its own: a posting row has a term's items of one block
of ``BLOCK_ITEMS`` numbers, with the largest term count and the smallest item length among
them, from which follows the most that any of them can score. A search reads the rows of its
terms alone, bucket by bucket; within a bucket the blocks come by falling bound, and a block
that can't reach a query's k-th score so far isn't scored for it. A common term has a row for
each block, so its list is as spread as the items are.

A sync rewrites the buckets that hold an inserted, changed or deleted key, and no other:
each of the index's tables is partitioned by bucket, and only those partitions are replaced.
Chunks come last, so a sync that died halfway finds its changes again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.functions import text as T
from docloom.operators.embed import embed_text
from docloom.operators.retrieve import B, DIGITS, K1, MATRIX_CELLS, QUERY_LIMIT, QUERY_WEIGHT, _plain, _rounded, _slices, metadata_filter, top_k_per_query
from docloom.session import materialize
from docloom.sources.tables import bucket_of, content_hash, move_buckets, touched_buckets, write_buckets

BUCKET_ITEMS, BLOCK_ITEMS = 1 << 16, 512
#: Fewest buckets, so that a small index is searched by more than one task.
LEAST_BUCKETS = 8
#: Terms that are named in the scan's filter; more are joined.
TERMS_PUSHED = 1000
#: Columns that the index adds to the chunks.
BUILT = ("tokens", "vector", "n_tokens", "content_hash", "no", "bucket")


@dataclass(frozen=True)
class StoredIndex:
    """An index folder: ``chunks`` (with BUILT), ``postings`` and ``sizes``."""

    spark: SparkSession
    path: str
    key: str
    text: str
    embedded: str | None
    dim: int
    buckets: int

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def chunks(self) -> DataFrame:
        return self._table("chunks")

    @property
    def postings(self) -> DataFrame:
        """Rows (term, block, n, max_tf, min_length, nos, tfs, lengths, bucket)."""
        return self._table("postings")

    @property
    def sizes(self) -> DataFrame:
        """Rows (items, words, bucket)."""
        return self._table("sizes")

    def keyword_topk(self, queries: DataFrame, k: int = 10, **names) -> DataFrame:
        return posting_topk(queries, self, k, **names)


# -------------------------------------------------------------- building ----
def postings_of(chunks: DataFrame) -> DataFrame:
    """Posting rows of numbered chunks (bucket, no, tokens, n_tokens), those of a bucket together in its order.

    Words travel once, as one string a chunk; a task counts its buckets' blocks as arrays.
    """
    schema = "term string, block int, n int, max_tf int, min_length int, nos array<int>, tfs array<int>, lengths array<int>, bucket int"
    words = chunks.where("size(tokens) > 0").select("bucket", "no", "n_tokens", F.array_join("tokens", " ").alias("words"))
    size = BLOCK_ITEMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a block's items may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            key = held.column("bucket").to_numpy().astype(np.int64) << 32 | held.column("no").to_numpy() // size
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if whole:
                yield from _posted(held.slice(0, whole), key[:whole])
                held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield from _posted(held, held.column("bucket").to_numpy().astype(np.int64) << 32 | held.column("no").to_numpy() // size)

    dealt = words.repartition("bucket").sortWithinPartitions("bucket", "no")
    return dealt.mapInArrow(run, schema).sortWithinPartitions("bucket", "term", "block")


def _posted(items: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Posting rows of whole blocks, which ``key`` tells apart; items come in its order and that of their numbers."""
    split = pc.split_pattern(items.column("words").combine_chunks(), " ")
    row = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    encoded = split.flatten().dictionary_encode()
    width = len(encoded.dictionary)
    pairs, tf = np.unique(row * width + encoded.indices.to_numpy(), return_counts=True)
    row, term = pairs // width, pairs % width
    group = np.unique(key, return_inverse=True)[1][row] * width + term
    order = np.argsort(group, kind="stable")
    group, row, term, tf = group[order], row[order], term[order], tf[order].astype(np.int32)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = pa.array(np.append(starts, len(group)).astype(np.int32))
    no, length = (items.column(c).to_numpy().astype(np.int32)[row] for c in ("no", "n_tokens"))
    first = key[row[starts]]
    columns = {
        "term": encoded.dictionary.take(pa.array(term[starts])), "block": pa.array((first & 0xFFFFFFFF).astype(np.int32)),
        "n": pa.array(np.diff(ends.to_numpy())), "max_tf": pa.array(np.maximum.reduceat(tf, starts)), "min_length": pa.array(np.minimum.reduceat(length, starts)),
        **{name: pa.ListArray.from_arrays(ends, pa.array(values)) for name, values in (("nos", no), ("tfs", tf), ("lengths", length))},
        "bucket": pa.array((first >> 32).astype(np.int32)),
    }
    rows = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    for start in range(0, rows.num_rows, 50_000):
        yield rows.slice(start, 50_000)


def _built(index: StoredIndex, chunks: DataFrame) -> DataFrame:
    """Chunks with what doesn't depend on their neighbours, but for their words, which are longer than the text."""
    rows = chunks.withColumn("content_hash", content_hash(chunks, index.key))
    if index.embedded:
        rows = embed_text(rows, index.embedded, index.dim, into="vector")
    return rows.withColumn("bucket", bucket_of(index.key, index.buckets))


def _write(index: StoredIndex, rows: DataFrame, touched: list[int] | None) -> None:
    """Number the rows of whole buckets and replace these buckets' partitions; ``touched`` buckets without rows go.

    One shuffle of the rows; they are split into words after it.
    """
    order = Window.partitionBy("bucket").orderBy(index.key)
    numbered = rows.withColumn("no", (F.row_number().over(order) - 1).cast("int"))
    numbered = numbered.withColumn("tokens", T.tokens(index.text)).withColumn("n_tokens", F.coalesce(F.size("tokens"), F.lit(0)))
    embedded = ["vector"] if index.embedded else []
    last = ["tokens", *embedded, "n_tokens", "no", "bucket"]
    numbered = numbered.select(*[c for c in numbered.columns if c not in last], *last)
    if touched is None:  # a new index: nothing is read from the folder that is written
        write_buckets(numbered, f"{index.path}/chunks")
        staged = index.chunks
    else:  # beside the index, so that its buckets are moved into place and not written again
        folder = f"{index.path}/_chunks-{uuid.uuid4().hex}"
        write_buckets(numbered, folder)
        staged = index.spark.read.schema(numbered.schema).parquet(folder)
    write_buckets(postings_of(staged), f"{index.path}/postings", touched, staged.where("n_tokens > 0"))
    sizes = staged.groupBy("bucket").agg(F.count(F.lit(1)).alias("items"), F.sum(F.col("n_tokens").cast("long")).alias("words"))
    write_buckets(sizes.select("items", "words", "bucket").coalesce(1), f"{index.path}/sizes", touched, staged)
    if touched is not None:
        move_buckets(index.spark, folder, f"{index.path}/chunks", touched)


def write_index(chunks: DataFrame, path: str, key: str = "chunk_id", text: str = "chunk_text", embedded: str | None = "chunk_to_embed",
                dim: int = 64, buckets: int | None = None) -> StoredIndex:
    """Build the index of ``chunks`` in a folder that all executors share."""
    taken = set(BUILT) & set(chunks.columns)
    if taken:
        raise ValueError(f"the index adds columns of these names: {sorted(taken)}")
    buckets = buckets or max(LEAST_BUCKETS, math.ceil(chunks.count() / BUCKET_ITEMS))
    index = StoredIndex(chunks.sparkSession, path, key, text, embedded, dim, buckets)
    _write(index, _built(index, chunks), None)
    about = {k: v for k, v in index.__dict__.items() if k not in ("spark", "path")}
    index.spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    return index


def open_index(spark: SparkSession, path: str) -> StoredIndex:
    """An index that was written before."""
    return StoredIndex(spark, path, **json.loads(spark.read.parquet(f"{path}/about").first()["about"]))


def sync_index(index: StoredIndex, chunks: DataFrame) -> DataFrame:
    """Bring the index in step with ``chunks`` and return the change set (key, change).

    Keys and content hashes are compared, the index's own as stored. Only inserted and changed
    rows are embedded, and only their buckets and those of deleted rows are rewritten.
    """
    key = index.key
    fresh = chunks.select(key, content_hash(chunks, key).alias("_new"), F.lit(True).alias("_here"))
    known = index.chunks.select(key, F.col("content_hash").alias("_old"), F.lit(True).alias("_there"))
    change = (
        F.when(F.col("_there").isNull(), "insert").when(F.col("_here").isNull(), "delete")
        .when(F.col("_old") == F.col("_new"), "same").otherwise("update")
    )
    changes = materialize(known.join(fresh, key, "full_outer").select(key, change.alias("change")), "index-changes")
    touched = touched_buckets(changes, key, index.buckets)
    if touched:
        stored = index.chunks
        kept = stored.where(F.col("bucket").isin(touched)).join(changes.where("change = 'same'").select(key), key, "left_semi")
        come = chunks.join(changes.where(F.col("change").isin("insert", "update")).select(key), key, "left_semi").select(*chunks.columns)
        columns = [c for c in stored.columns if c not in ("no", "tokens", "n_tokens")]
        _write(index, kept.select(*columns).unionByName(_built(index, come).select(*columns)), touched)
    return changes


# ------------------------------------------------------------- searching ----
class _Lists:
    """The queries' weighted terms as arrays: which queries ask for each term, and how much it weighs for them."""

    def __init__(self, queries: pa.Table, mean_length: float):
        payload = queries.column("q_payload").combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(payload), 0).to_numpy(zero_copy_only=False)
        flat = pc.list_flatten(payload)
        encoded = pc.struct_field(flat, "term").dictionary_encode()
        if isinstance(encoded, pa.ChunkedArray):
            encoded = encoded.combine_chunks()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        by_term = np.argsort(codes, kind="stable")
        self.terms = encoded.dictionary
        self.owner = np.repeat(np.arange(len(payload)), lengths)[by_term]
        self.starts = np.searchsorted(codes[by_term], np.arange(len(self.terms) + 1))
        self.idf = np.zeros(len(self.terms))
        self.idf[codes] = pc.struct_field(flat, "idf").to_numpy(zero_copy_only=False)
        self.width, self.mean_length = len(payload), mean_length
        only = queries.column("q_only").combine_chunks()
        self.only = _plain(pc.fill_null(only, ""))
        self.any = pc.is_null(only).to_numpy(zero_copy_only=False)

    def weight(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        scale = K1 * (1 - B + B * length / self.mean_length)
        return self.idf[term] * tf * (K1 + 1) / (tf + scale)

    def sums(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """``weight`` of (row, term) added up for each row and query that asks for the term."""
        fan = self.starts[term + 1] - self.starts[term]
        total = np.zeros(rows * self.width)
        for part in _slices(fan, MATRIX_CELLS):  # a word of every query fans out to all of them
            f = fan[part]
            offset = np.arange(f.sum()) - np.repeat(np.cumsum(f) - f, f)
            owner = self.owner[np.repeat(self.starts[term[part]], f) + offset]
            total += np.bincount(np.repeat(row[part], f) * self.width + owner, weights=np.repeat(weight[part], f), minlength=len(total))
        return total.reshape(rows, self.width)


class BlockSearch:
    """Best items of every query, bucket by bucket; ``skipped`` and ``scored`` count (query, block) pairs that have a term in common."""

    def __init__(self, lists: _Lists, k: int):
        self.lists, self.k = lists, k
        self.floor = np.zeros(lists.width)  # a score that the k-th best reaches at least
        self.skipped = self.scored = 0

    def bucket(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, no, score) of the best items of one bucket, ties to the smaller number."""
        lists = self.lists
        about = pc.is_null(rows.column("term")).to_numpy(zero_copy_only=False)
        marks = {r["block"]: r for r in rows.filter(pa.array(about)).to_pylist()}
        rows = rows.filter(pa.array(~about)).combine_chunks()
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if not rows.num_rows:
            return none
        term = pc.index_in(rows.column("term"), value_set=lists.terms)
        if term.null_count:  # no filtered item has it
            rows, term = rows.filter(term.is_valid()).combine_chunks(), term.drop_null()
        if not rows.num_rows:
            return none
        term = term.to_numpy().astype(np.int64)
        blocks, block = np.unique(rows.column("block").to_numpy(), return_inverse=True)
        most = lists.weight(term, rows.column("max_tf").to_numpy(), rows.column("min_length").to_numpy())
        bound = lists.sums(block, term, most, len(blocks))
        of_block = np.argsort(block, kind="stable")
        first = np.searchsorted(block[of_block], np.arange(len(blocks) + 1))
        kept = none
        for b in np.argsort(-bound.max(axis=1), kind="stable").tolist():
            reach = (bound[b] > 0) & (bound[b] + 10.0**-DIGITS >= self.floor)
            self.skipped += int((bound[b] > 0).sum() - reach.sum())
            self.scored += int(reach.sum())
            if reach.any():
                kept = self._merge(kept, *self._score(rows.take(pa.array(of_block[first[b] : first[b + 1]])), term[of_block[first[b] : first[b + 1]]], reach, marks.get(int(blocks[b]))))
        return kept

    def _score(self, rows: pa.Table, term: np.ndarray, reach: np.ndarray, mark: dict | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = self.lists
        sizes = rows.column("n").to_numpy()
        nos, tfs, lengths = (rows.column(c).combine_chunks().flatten().to_numpy() for c in ("nos", "tfs", "lengths"))
        term = np.repeat(term, sizes)
        items, row = np.unique(nos, return_inverse=True)
        scores = lists.sums(row, term, lists.weight(term, tfs, lengths), len(items))
        scores = np.where(scores > 0, _rounded(scores), -np.inf)
        scores[:, ~reach] = -np.inf
        if mark is not None:  # a filter holds, or queries ask for a tag
            allowed = np.array(mark["nos"], np.int64)
            at = np.searchsorted(allowed, items)
            at[at == len(allowed)] = 0
            good = allowed[at] == items if len(allowed) else np.zeros(len(items), bool)
            scores[~good] = -np.inf
            if mark["tags"] is not None and not lists.any.all():
                tags = np.array([t if t is not None else "\0" for t in mark["tags"]])[at] if len(allowed) else np.zeros(len(items), str)
                scores[~(lists.any[None, :] | (tags[:, None] == lists.only[None, :]))] = -np.inf
        at, query = np.nonzero((scores >= self.floor[None, :]) & (scores > -np.inf))
        return query, items[at].astype(np.int64), scores[at, query]

    def _merge(self, kept, query: np.ndarray, no: np.ndarray, score: np.ndarray):
        query, no, score = (np.concatenate(x) for x in zip(kept, (query, no, score), strict=True))
        order = np.lexsort((no, -score, query))
        query, no, score = query[order], no[order], score[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        last = nth == self.k - 1
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        return tuple(x[nth < self.k] for x in (query, no, score))


ROW = "bucket int, block int, term string, n int, max_tf int, min_length int, nos array<int>, tfs array<int>, lengths array<int>, tags array<string>"


def _search_lists(rows: DataFrame, queries: DataFrame, mean_length: float, k: int) -> DataFrame:
    """(query_id, bucket, no, score): each query's k best of every bucket, from ROWs of its terms; floors go from bucket to bucket of a task."""
    block = rows.sparkSession.sparkContext.broadcast(queries.toArrow())  # within QUERY_LIMIT and QUERY_WEIGHT
    schema = st.StructType([queries.schema["query_id"], st.StructField("bucket", st.IntegerType()), st.StructField("no", st.IntegerType()), st.StructField("score", st.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = block.value
        search = BlockSearch(_Lists(table, mean_length), k) if table.num_rows else None
        ids, held = table.column("query_id").combine_chunks(), []

        def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            query, no, score = search.bucket(pa.Table.from_batches(parts))
            number = np.full(len(no), parts[0].column("bucket")[0].as_py(), np.int32)
            return pa.RecordBatch.from_arrays([ids.take(pa.array(query)), pa.array(number), pa.array(no.astype(np.int32)), pa.array(score)], names=schema.names)

        for batch in batches if search else ():
            numbers = batch.column("bucket").to_numpy()
            for low, high in _spans(numbers):
                if held and held[0].column("bucket")[0].as_py() != numbers[low]:
                    yield done(held)
                    held = []
                held.append(batch.slice(low, high - low))
        if held:
            yield done(held)

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _spans(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]])) if len(values) else np.zeros(1, int)
    yield from zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)


def posting_topk(queries: DataFrame, index: StoredIndex, k: int = 10, *, query_id: str = "query_id", query_text: str = "question",
                 filters: str | dict | None = None, query_only: str | None = None, item_only: str | None = None) -> DataFrame:
    """BM25 top-k over distinct query terms from the stored lists: ``query_id, item_id, score, rank``.

    With ``filters`` the counts are those of the filtered items, as if they alone were indexed. More
    queries than ``QUERY_LIMIT`` go in blocks, each reading the lists of its own terms.
    """
    only = F.col(query_only).cast("string") if query_only else F.lit(None).cast("string")
    asked = materialize(queries.select(F.col(query_id).alias("query_id"), F.array_distinct(T.tokens(query_text)).alias("terms"), only.alias("q_only")), "asked")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.coalesce(F.size("terms"), F.lit(0))), F.lit(0)).alias("w")).first()
    blocks = max(1, math.ceil(size["n"] / (QUERY_LIMIT // 2)), math.ceil(size["w"] / (QUERY_WEIGHT // 2))) if size["n"] > QUERY_LIMIT or size["w"] > QUERY_WEIGHT else 1
    of = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    allowed = None
    if filters or item_only:
        tag = F.col(item_only).cast("string") if item_only else F.lit(None).cast("string")
        items = index.chunks.where(metadata_filter(filters)) if filters else index.chunks
        items = items.select("bucket", F.floor(F.col("no") / BLOCK_ITEMS).cast("int").alias("block"), "no", tag.alias("tag"), "n_tokens")
        held = F.array_sort(F.collect_list(F.struct("no", "tag")))
        allowed = items.groupBy("bucket", "block").agg(held.alias("held"), F.count(F.lit(1)).alias("items"), F.sum(F.col("n_tokens").cast("long")).alias("words"))
        allowed = materialize(allowed.select("bucket", "block", F.transform("held", lambda h: h["no"]).alias("nos"), F.transform("held", lambda h: h["tag"]).alias("tags"), "items", "words"), "allowed")
    sizes = allowed if filters else index.sizes
    number, total = sizes.agg(F.coalesce(F.sum("items"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    mean_length = float(total) / number if number and total else 1.0
    found = [_block_topk(asked.where(of == b) if blocks > 1 else asked, index, allowed, bool(filters), bool(item_only), float(number), mean_length, k) for b in range(blocks)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    best = materialize(best, "candidates")  # k of a bucket at most: joined to the keys by its known size
    named = index.chunks.select("bucket", "no", F.col(index.key).alias("item_id")).join(best, ["bucket", "no"]).select("query_id", "item_id", "score")
    return top_k_per_query(named, k)


def _block_topk(asked: DataFrame, index: StoredIndex, allowed: DataFrame | None, filtered: bool, tagged: bool, number: float, mean_length: float, k: int) -> DataFrame:
    words = asked.select("query_id", F.explode("terms").alias("term"))
    wanted = materialize(words.select("term").distinct(), "query-terms")
    lists = index.postings
    if wanted.count() <= TERMS_PUSHED:
        terms = [r["term"] for r in wanted.collect()]  # TERMS_PUSHED at most
        lists = lists.where(F.col("term").isin(terms) if terms else F.lit(False))
    else:
        lists = lists.join(wanted, "term", "left_semi")
    if filtered:
        held = lists.join(allowed.select("bucket", "block", F.col("nos").alias("allowed")), ["bucket", "block"])
        counted = held.select("term", F.size(F.array_intersect("nos", "allowed")).alias("n"))
    else:
        counted = lists.select("term", "n")
    df = F.col("df").cast("double")
    counts = counted.groupBy("term").agg(F.sum(F.col("n").cast("long")).alias("df")).where("df > 0")
    idf = F.log(1 + (F.lit(number) - df + 0.5) / (df + 0.5))
    weighted = words.join(materialize(counts, "term-counts").select("term", idf.alias("idf")), "term").groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("q_payload"))
    weighted = materialize(weighted.join(asked.select("query_id", "q_only"), "query_id"), "weighted")
    rows = lists.select("bucket", "block", "term", "n", "max_tf", "min_length", "nos", "tfs", "lengths", F.lit(None).cast("array<string>").alias("tags"))
    if filtered or tagged:
        marks = allowed.select("bucket", "block", F.lit(None).cast("string").alias("term"), F.lit(0).alias("n"), F.lit(0).alias("max_tf"), F.lit(0).alias("min_length"), "nos", *(F.array().cast("array<int>").alias(c) for c in ("tfs", "lengths")), "tags")
        rows = rows.join(allowed.select("bucket", "block"), ["bucket", "block"], "left_semi").select(*rows.columns).unionByName(marks) if filtered else rows.unionByName(marks)
    return _search_lists(rows, weighted, mean_length, k)
