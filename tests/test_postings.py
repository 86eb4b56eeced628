"""The stored index: keyword search on its lists against a scan of the corpus, and its sync."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.operators import postings as PX
from docloom.operators import retrieve as R


def corpus(spark, n=600, seed=4, copies=60):
    """Chunks of a few common and many rare words; the first text comes again and again."""
    draw = np.random.default_rng(seed)
    words = np.array([f"w{k}" for k in range(300)])
    texts = [" ".join(words[np.minimum(draw.zipf(1.3, draw.integers(1, 40)) - 1, 299)]) for _ in range(n)]
    texts += [texts[0]] * copies + [None, "", "..."]
    rows = [(f"c{k:04d}", t, f"Page 0\n{t}", "ab"[k % 2] if k % 7 else None) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "chunk_id string, chunk_text string, chunk_to_embed string, kind string").repartition(4, "chunk_id")


def questions(spark, n=40, seed=9):
    draw = np.random.default_rng(seed)
    rows = [(q, " ".join(f"w{k}" for k in np.minimum(draw.zipf(1.2, draw.integers(1, 9)) - 1, 320)), "ab"[q % 2] if q % 3 else None) for q in range(n)]
    return spark.createDataFrame([*rows, (n, None, None), (n + 1, "unknown words", "a")], "query_id int, question string, only string")


def told(df):
    return sorted((r["query_id"], r["rank"], r["item_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def chunks(spark):
    return corpus(spark).cache()


@pytest.fixture(scope="module", params=[(512, 8), (16, 3)])
def index(spark, chunks, tmp_path_factory, request):
    size, buckets = request.param
    before, PX.BLOCK_ITEMS = PX.BLOCK_ITEMS, size
    yield PX.write_index(chunks, str(tmp_path_factory.mktemp("index")), buckets=buckets)
    PX.BLOCK_ITEMS = before


TAGS = {"query_only": "only", "item_only": "kind"}


@pytest.mark.parametrize("k, options", [(1, {}), (1000, {}), (7, {"filters": {"kind": "a"}}), (7, TAGS), (7, {"filters": {"kind": ["a", "b"]}, **TAGS}), (7, {"filters": {"kind": "none"}})])
def test_lists_answer_as_a_scan_does(spark, chunks, index, k, options):
    asked = questions(spark)
    assert told(R.bm25_topk(asked, index, k, **options)) == told(R.bm25_topk(asked, chunks, k, **options))


def test_many_queries_go_in_blocks(spark, chunks, index, monkeypatch):
    asked = questions(spark)
    want = told(R.bm25_topk(asked, chunks, 5))
    monkeypatch.setattr(PX, "QUERY_LIMIT", 12)
    monkeypatch.setattr(PX, "TERMS_PUSHED", 3)
    assert told(R.bm25_topk(asked, index, 5)) == want
    assert R.bm25_topk(asked.limit(0), index, 5).count() == 0


def test_hybrid_search_takes_the_index(spark, index):
    asked = questions(spark).withColumn("vector", F.array(*(F.lit(float(n % 3)) for n in range(64))))
    columns = ["kind"]
    got = R.search(asked, index, columns, 5, "HYBRID", {"kind": "b"})
    want = R.search(asked, index.chunks, columns, 5, "HYBRID", {"kind": "b"})
    assert told(got) == told(want) and {r["kind"] for r in got.collect()} == {"b"}


def rows_of_bucket(blocks):
    """Posting rows of one bucket; ``blocks`` holds (term, block, [(no, tf, length)])."""
    rows = [{"bucket": 0, "block": b, "term": t, "n": len(p), "max_tf": max(x[1] for x in p), "min_length": min(x[2] for x in p),
             "nos": [x[0] for x in p], "tfs": [x[1] for x in p], "lengths": [x[2] for x in p], "tags": None} for t, b, p in blocks]
    small = pa.int32()
    kinds = [("bucket", small), ("block", small), ("term", pa.string()), ("n", small), ("max_tf", small), ("min_length", small), *((c, pa.list_(small)) for c in ("nos", "tfs", "lengths")), ("tags", pa.list_(pa.string()))]
    return pa.Table.from_pylist(rows, schema=pa.schema(kinds))


def test_blocks_that_cannot_reach_the_best_are_skipped():
    payload = pa.list_(pa.struct([("term", pa.string()), ("idf", pa.float64())]))
    queries = pa.table({"query_id": pa.array([1, 2]), "q_payload": pa.array([[{"term": "a", "idf": 2.0}], [{"term": "a", "idf": 2.0}, {"term": "b", "idf": 1.0}]], payload), "q_only": pa.array([None, None], pa.string())})
    search = PX.BlockSearch(PX._Lists(queries, 10.0), 2)
    blocks = [("a", 0, [(0, 1, 30), (1, 1, 40)]), ("a", 1, [(5, 9, 10), (6, 9, 10)]), ("a", 2, [(9, 2, 30)]), ("b", 2, [(8, 1, 30)])]
    query, no, _ = search.bucket(rows_of_bucket(blocks))
    assert sorted(zip(query.tolist(), no.tolist(), strict=True)) == [(0, 5), (0, 6), (1, 5), (1, 6)]
    assert (search.scored, search.skipped) == (2, 4)  # the second block comes first, and nothing reaches its scores
    query, no, _ = search.bucket(rows_of_bucket([("a", 0, [(3, 9, 10)]), ("b", 1, [(4, 1, 99)])]))
    assert sorted(zip(query.tolist(), no.tolist(), strict=True)) == [(0, 3), (1, 3)]  # a tie with another bucket stays
    assert search.skipped == 5


def test_real_lists_skip_blocks_too(spark, chunks, tmp_path, monkeypatch):
    monkeypatch.setattr(PX, "BLOCK_ITEMS", 8)
    index = PX.write_index(chunks, str(tmp_path / "i"), buckets=1)
    lists = index.postings.toArrow().append_column("tags", pa.nulls(index.postings.count(), pa.list_(pa.string())))
    df = {r["term"]: r["df"] for r in index.postings.groupBy("term").agg(F.sum("n").alias("df")).collect()}
    terms = ["w0", "w1", "w50"]
    payload = [[{"term": t, "idf": float(np.log(1 + (663 - df[t] + 0.5) / (df[t] + 0.5)))} for t in terms]]
    queries = pa.table({"query_id": pa.array([1]), "q_payload": pa.array(payload), "q_only": pa.array([None], pa.string())})
    search = PX.BlockSearch(PX._Lists(queries, 12.0), 3)
    search.bucket(lists.filter(pa.compute.is_in(lists.column("term"), pa.array(terms))))
    assert search.skipped > search.scored > 0


def tables(index):
    chunks = sorted(map(str, index.chunks.select(*sorted(index.chunks.columns)).collect()))
    lists = sorted(map(str, index.postings.select(*sorted(index.postings.columns)).collect()))
    return chunks, lists, sorted(map(str, index.sizes.collect()))


def test_a_sync_equals_a_rebuild_and_rewrites_changed_buckets_only(spark, chunks, tmp_path):
    index = PX.write_index(chunks, str(tmp_path / "index"), buckets=32)
    files = lambda: {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in (tmp_path / "index").rglob("*.parquet")}
    before = files()
    new = chunks.where("chunk_id <> 'c0005'").withColumn("chunk_text", F.when(F.col("chunk_id") == "c0009", "w1 w1 fresh").otherwise(F.col("chunk_text")))
    new = new.unionByName(spark.createDataFrame([("zz", "new w2", "new", "a")], chunks.schema))
    changes = {r["chunk_id"]: r["change"] for r in PX.sync_index(index, new).where("change <> 'same'").collect()}
    assert changes == {"c0005": "delete", "c0009": "update", "zz": "insert"}
    after = files()
    touched = {f.split("/")[2] for f in before if f not in after}
    assert len(touched) <= 3 and all(after[f] == before[f] for f in before if "bucket=" in f and f.split("/")[2] not in touched)
    assert tables(PX.open_index(spark, index.path)) == tables(PX.write_index(new, str(tmp_path / "again"), buckets=32))
    unchanged = files()
    assert PX.sync_index(index, new).where("change <> 'same'").count() == 0 and files() == unchanged
    few = new.where("chunk_id < 'c0003'")
    PX.sync_index(index, few)
    assert tables(index) == tables(PX.write_index(few, str(tmp_path / "few"), buckets=32))


def test_the_index_refuses_columns_of_its_own_names(spark, chunks, tmp_path):
    with pytest.raises(ValueError):
        PX.write_index(chunks.withColumn("no", F.lit(1)), str(tmp_path / "x"))


def test_posting_rows_cross_batches_and_shuffle_words_once(spark, index):
    """Each (bucket, term, block) has one row however the items are batched, as counted by hand."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        postings = PX.postings_of(index.chunks)
        assert postings._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        got = {(r["bucket"], r["term"], r["block"]): (r["n"], r["max_tf"], r["min_length"], r["nos"], r["tfs"], r["lengths"]) for r in postings.collect()}
        assert len(got) == postings.count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = {}
    for r in sorted(index.chunks.collect(), key=lambda r: r["no"]):
        for term in set(r["tokens"] or []):
            want.setdefault((r["bucket"], term, r["no"] // PX.BLOCK_ITEMS), []).append((r["no"], r["tokens"].count(term), r["n_tokens"]))
    assert got == {k: (len(v), max(x[1] for x in v), min(x[2] for x in v), *map(list, zip(*v))) for k, v in want.items()}


def test_a_new_index_is_written_without_a_copy(spark, chunks, tmp_path):
    from docloom.session import scratch_folder
    from pathlib import Path

    folder = Path(scratch_folder(spark).removeprefix("file://"))
    staged = lambda: set(folder.glob("index-chunks-*"))
    before = staged()
    PX.write_index(chunks, str(tmp_path / "i"), buckets=2)
    assert staged() == before


def test_a_sync_writes_changed_chunks_once(spark, chunks, tmp_path, monkeypatch):
    index = PX.write_index(chunks, str(tmp_path / "index"), buckets=8)
    written, write = [], PX.write_buckets
    monkeypatch.setattr(PX, "write_buckets", lambda df, path, *more: written.append((path, "tokens" in df.columns)) or write(df, path, *more))
    new = chunks.where("chunk_id > 'c0100'")
    PX.sync_index(index, new)
    assert sum(has_chunks for _, has_chunks in written) == 1
    assert not [f for f in (tmp_path / "index").iterdir() if f.name.startswith("_")]  # moved, nothing is left behind
    assert sorted(r.chunk_id for r in index.chunks.collect()) == sorted(r.chunk_id for r in new.collect())
