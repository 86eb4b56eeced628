import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.operators import retrieve as R
from docloom.operators.embed import embed_text
from docloom.plans.workload import QUERIES
from docloom.sources import tables as ST


def vectors(spark, n, dim=16, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    data = [(i, rng.standard_normal(dim).tolist(), "ab"[i % 2]) for i in range(n)]
    data += [(n + i, data[0][1], "a") for i in range(copies)]
    return spark.createDataFrame(data, "id bigint, v array<double>, kind string").repartition(5, "id")


def brute(queries, items, k, same=False, only=None):
    out = {}
    for q in queries:
        scored = []
        for i in items:
            if same and q.id == i.id or only and not only(q, i):
                continue
            a, b = np.array(q.v), np.array(i.v)
            scored.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 6), i.id))
        out[q.id] = [i for _, i in sorted(scored)[:k]]
    return out


def ranked(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.item_id))
    assert all(sorted(n for n, _ in v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [i for _, i in sorted(v)] for q, v in out.items()}


KEYS = dict(query_id="id", item_id="id", query_vector="v", item_vector="v")


def test_vector_topk_is_exact_with_copies(spark):
    items, queries = vectors(spark, 300, copies=40), vectors(spark, 300).where("id < 20")
    want = brute(queries.collect(), items.collect(), 7)
    assert ranked(R.vector_topk(queries, items, 7, **KEYS)) == want
    assert len(set(want[0])) == 7  # forty copies tie: the smallest ids win


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_large_query_sets_walk_over_unmoved_items(spark, tmp_path, monkeypatch):
    vectors(spark, 200, copies=10).write.parquet(str(tmp_path / "v"))
    items = spark.read.parquet(str(tmp_path / "v"))
    want = brute(items.collect(), items.collect(), 4, same=True)
    monkeypatch.setattr(R, "QUERY_LIMIT", 30)
    monkeypatch.setattr(R, "WALK_ROWS", 40)
    found = R.vector_topk(items, items, 4, skip_same=True, **KEYS)
    assert len(exchanges(found)) == 1  # the ranks, not the corpus
    assert ranked(found) == want


def test_queries_meet_items_of_their_own_tag_only(spark, monkeypatch):
    items = vectors(spark, 90)
    queries = items.withColumn("only", F.when(F.col("id") % 5 > 1, F.col("kind")))
    want = brute(queries.collect(), items.collect(), 3, only=lambda q, i: q.only is None or q.only == i.kind)
    met = []

    class Counted(R._Cosine):
        def score(self, payload):
            met.append(len(payload) * len(self.unit))
            return super().score(payload)

    rows = R._item_side(items, "id", F.col("v"), "kind").toArrow()
    asked = R._query_side(queries, "id", F.col("v"), "only").toArrow()
    best = R._BestByTag(asked, Counted, 3, False)
    best.add(rows)
    free = sum(q["only"] is None for q in queries.collect())
    assert sum(met) == free * 90 + (90 - free) // 2 * 90  # half of the items for each tagged query
    monkeypatch.setattr(R, "QUERY_LIMIT", 7)
    assert ranked(R.vector_topk(queries, items, 3, query_only="only", item_only="kind", **KEYS)) == want


def test_filters_come_before_ranking(spark):
    items, queries = vectors(spark, 100), vectors(spark, 100).where("id < 5")
    want = brute(queries.collect(), [i for i in items.collect() if i.kind == "b"], 5)
    assert ranked(R.vector_topk(queries, items, 5, filters='{"kind": "b"}', **KEYS)) == want
    assert ranked(R.vector_topk(queries, items, 5, filters={"kind LIKE": "b"}, **KEYS)) == want
    assert ranked(R.vector_topk(queries, items, 5, filters={"kind": ["b"]}, **KEYS)) == want
    with pytest.raises(ValueError):
        R.metadata_filter({"kind >": 1})


def test_filter_per_query(spark):
    items = vectors(spark, 60)
    queries = items.where("id < 6").withColumn("only", F.when(F.col("id") > 2, F.col("kind")))
    want = brute(queries.collect(), items.collect(), 3, only=lambda q, i: q.only is None or q.only == i.kind)
    assert ranked(R.vector_topk(queries, items, 3, query_only="only", item_only="kind", **KEYS)) == want


def test_null_and_zero_vectors_match_nothing(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [0.0, 1.0])], "id bigint, v array<double>")
    got = R.vector_topk(items.where("id = 1"), items, 9, **KEYS).orderBy("rank").collect()
    assert [(r.item_id, r.score) for r in got] == [(1, 1.0), (4, 0.0)]


def test_no_queries_or_no_items(spark):
    items = vectors(spark, 10)
    assert R.vector_topk(items.limit(0), items, 3, **KEYS).count() == 0
    assert R.vector_topk(items, items.limit(0), 3, **KEYS).count() == 0


def test_ann_finds_most_neighbours_and_splits_hot_lists(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 16))
    data = [(i, (centres[i % 8 if i % 3 else 0] + 0.3 * rng.standard_normal(16)).tolist(), "a") for i in range(600)]
    items = spark.createDataFrame(data, "id bigint, v array<double>, kind string").repartition(4, "id")
    want = brute(items.collect(), items.collect(), 5, same=True)
    monkeypatch.setattr(R, "CELL_ROWS", 50)  # a third of the rows sit around one centre
    centroids = R.train_centroids(items, "v", lists=8)
    got = ranked(R.ann_topk(items, items, 5, centroids=centroids, probes=2, skip_same=True, **KEYS))
    recall = np.mean([len(set(got.get(q, [])) & set(w)) / 5 for q, w in want.items()])
    assert recall > 0.9
    every = ranked(R.ann_topk(items, items, 5, centroids=centroids, probes=8, skip_same=True, **KEYS))
    assert every == want  # all lists probed: exact


@pytest.mark.parametrize("lists", [None, 150])
def test_ann_finds_the_wanted_share_however_many_lists(spark, lists):
    sf = "/root/testdata/sf0.01"
    every = spark.read.parquet(f"{sf}/embeddings.parquet")
    names = dict(query_id="vec_id", item_id="vec_id", query_vector="embedding", item_vector="embedding", skip_same=True)
    if lists:
        found = R.ann_topk(every, every, 10, centroids=R.train_centroids(every, "embedding", lists=lists), **names)
    else:
        found = QUERIES["ann_topk"](spark, sf)
    got, want = ranked(found), ranked(R.vector_topk(every, every, 10, **names))
    hits = [len(set(got.get(q, [])) & set(w)) for q, w in want.items()]
    assert sum(hits) >= 0.9 * sum(map(len, want.values()))


def test_ann_on_tiny_inputs(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id bigint, v array<double>")
    assert ranked(R.ann_topk(one, one, 3, **KEYS)) == {1: [1]}
    assert R.ann_topk(one, one.limit(0), 3, **KEYS).count() == 0


DOCS = [
    ("d1", "the cat sat on the mat", "x"), ("d2", "the dog chased the cat and the cat ran", "y"),
    ("d3", "quantum chips", "x"), ("d4", "", "x"), ("d5", "the the the the the", "y"), ("d6", "the cat sat on the mat", "y"),
]


def bm25_by_hand(questions, docs, k):
    split = {i: t.split() for i, t, _ in docs}
    mean = sum(map(len, split.values())) / len(split)
    out = {}
    for q, text in questions:
        scored = []
        for i, words in split.items():
            s = 0.0
            for w in set(text.lower().split()):
                df, tf = sum(w in d for d in split.values()), words.count(w)
                s += np.log(1 + (len(split) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / mean)) if tf else 0
            if s:
                scored.append((-round(s, 6), i))
        out[q] = [i for _, i in sorted(scored)[:k]]
    return {q: v for q, v in out.items() if v}


@pytest.mark.parametrize("limit", [4096, 1])
def test_bm25(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "QUERY_LIMIT", limit)
    monkeypatch.setattr(R, "CELL_ROWS", 2)
    monkeypatch.setattr(R, "MATRIX_CELLS", 3)
    asked = [(1, "the cat"), (2, "Quantum cat"), (3, "unseen words"), (4, "mat mat mat")]
    queries = spark.createDataFrame(asked, "query_id bigint, question string")
    docs = spark.createDataFrame(DOCS, "chunk_id string, chunk_text string, kind string").repartition(3, "chunk_id")
    got = R.bm25_topk(queries, docs, 4)
    assert ranked(got) == bm25_by_hand(asked, DOCS, 4)


def test_hybrid_citations_compare_and_eval(spark):
    queries = embed_text(spark.createDataFrame([(1, "cat on the mat"), (2, "quantum")], "query_id bigint, question string"), "question")
    docs = embed_text(spark.createDataFrame(DOCS, "chunk_id string, chunk_text string, source_path string"), "chunk_text")
    by_meaning, by_words = R.vector_topk(queries, docs, 3), R.bm25_topk(queries, docs, 3)
    hybrid = R.hybrid_topk(queries, docs, 3)
    a, b, h = ranked(by_meaning), ranked(R.bm25_topk(queries, docs, 50)), ranked(hybrid)
    everything = ranked(R.vector_topk(queries, docs, 50))
    assert all(set(v) <= set(everything[q]) | set(b.get(q, [])) for q, v in h.items())
    assert h[2][0] == "d3" and h[1][0] == "d1"
    table = {(r.query_id, r.item_id): (r.left_rank, r.right_rank) for r in R.compare_rankings(by_meaning, by_words).collect()}
    assert table[(2, "d3")] == (1, 1)
    assert set(table) == {(q, i) for q, v in [*a.items(), *ranked(by_words).items()] for i in v}
    cited = R.citations(R.with_columns(by_words, docs, ["source_path"])).where("query_id = 1").collect()
    assert {(r.source_path, r.best_rank) for r in cited} == {("x", 1), ("y", 2)}
    truth = spark.createDataFrame([(1, "d6"), (2, "d1"), (1, "d6")], "query_id bigint, item_id string")
    scored = R.retrieval_eval(by_words, truth, 3).first()
    assert (scored.queries, scored.hits, scored.hit_rate, scored.mrr) == (2, 1, 0.5, 0.25)


def test_requested_columns_come_with_the_score_last(spark):
    items = vectors(spark, 20)
    got = R.with_columns(R.vector_topk(items, items, 2, **KEYS), items, ["kind"], "id")
    assert got.columns == ["query_id", "rank", "item_id", "kind", "score"] and got.count() == 40


def test_search_front(spark):
    queries = embed_text(spark.createDataFrame([(1, "cat on the mat"), (2, "quantum")], "query_id bigint, question string"), "question")
    docs = embed_text(spark.createDataFrame(DOCS, "chunk_id string, chunk_text string, kind string"), "chunk_text")
    for query_type, direct in [("ANN", R.vector_topk), ("FULL_TEXT", R.bm25_topk), ("HYBRID", R.hybrid_topk)]:
        got = R.search(queries, docs, ["kind"], 2, query_type, {"kind": "x"})
        assert got.columns == ["query_id", "rank", "item_id", "kind", "score"]
        assert {r.kind for r in got.collect()} == {"x"}
        assert ranked(got) == ranked(direct(queries, docs, 2, filters={"kind": "x"}))
    near = R.search(queries, docs, ["kind"], 2, "ANN", centroids=R.train_centroids(docs))
    assert {r.query_id for r in near.collect()} == {1, 2}
    with pytest.raises(ValueError, match="query_type"):
        R.search(queries, docs, [], 2, "MAGIC")


def test_verbatim_hits(spark):
    passages = [(1, "Beta gamma!"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"), (3, "gamma"), (4, "lpha beta"), (5, "..."), (6, "beta beta")]
    docs = [("a", "Alpha beta, gamma delta epsilon zeta eta theta iota kappa"), ("b", "gamma beta gamma"), ("c", ""), ("d", "beta, beta.")]
    queries = spark.createDataFrame(passages, "query_id int, question string")
    corpus = spark.createDataFrame(docs, "chunk_id string, chunk_text string")
    got = sorted((r.query_id, r.item_id) for r in R.verbatim_hits(queries, corpus).collect())
    assert got == [(1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b"), (6, "d")]


def test_embedding_is_stable_and_normalised(spark):
    df = spark.createDataFrame([("cat cat dog",), ("dog cat CAT",), ("",), (None,)], "t string")
    a, b, empty, null = [r.vector for r in embed_text(df, "t", 8).collect()]
    assert a == b and abs(sum(abs(x) for x in a)) in (1.0, 3.0) and empty == [0.0] * 8 and null is None
    unit = embed_text(df, "t", 8, normalize=True).first().vector
    assert abs(sum(x * x for x in unit) - 1) < 1e-9


CHUNKS = "chunk_id string, chunk_to_embed string, company string"


def test_chunk_changes_and_apply(spark, rows):
    old = spark.createDataFrame([("a", "1", "X"), ("b", "2", None), ("c", "3", "X"), ("e", "5", "X")], CHUNKS)
    new = spark.createDataFrame([("a", "1", "X"), ("b", "2!", None), ("d", "4", "X"), ("e", "5", "Y")], CHUNKS)
    changes = ST.chunk_changes(old, new)
    assert rows(changes) == [("a", "same"), ("b", "update"), ("c", "delete"), ("d", "insert"), ("e", "update")]
    synced = ST.apply_changes(old, new, changes)
    assert rows(synced) == rows(new)
    assert {r.change for r in ST.chunk_changes(synced, new).collect()} == {"same"}


def test_routing_copies_some_rows_at_a_time(monkeypatch):
    """With every list probed a vector is copied for each list; no batch that leaves is much larger than ROUTE_CELLS."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(vectors.tolist())], names=["id", "v"])

    class Frame:
        schema = st.StructType([st.StructField("id", st.LongType()), st.StructField("v", st.ArrayType(st.DoubleType()))])

        def mapInArrow(self, function, schema):
            return list(function(iter([batch])))

    class Shared:
        value = rng.normal(size=(20, 8))

    monkeypatch.setattr(R, "ROUTE_CELLS", 4000, raising=False)
    out = R._routed(Frame(), "v", Shared(), 20)
    assert max(b.num_rows for b in out) * 8 <= 4000
    got = sorted(zip(*(c.to_pylist() for c in pa.Table.from_batches(out).select(["id", "list"]).columns), strict=True))
    assert got == [(k, c) for k in range(300) for c in range(20)]


@pytest.mark.parametrize("limit", [4096, 30])
def test_no_row_of_approximate_search_is_copied_for_a_list(spark, monkeypatch, limit):
    """However many lists are probed, a stored row is written once and a query's k best of a task leave it."""
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(i, rng.standard_normal(8).tolist()) for i in range(400)] + [(400, None), (401, [0.0] * 8), (7, [1.0] * 8)], "id bigint, v array<double>")
    copies = []
    routed = R._routed
    monkeypatch.setattr(R, "_routed", lambda df, vector, centroids, probes: copies.append(probes) or routed(df, vector, centroids, probes))
    monkeypatch.setattr(R, "QUERY_LIMIT", limit)
    monkeypatch.setattr(R, "PROBE_ROWS", 25)
    monkeypatch.setattr(R, "CELL_ROWS", 60)
    monkeypatch.setattr(R, "MERGE_ROWS", 10)
    centroids = R.train_centroids(items, "v", lists=20)
    every = R.ann_topk(items, items, 4, centroids=centroids, probes=20, skip_same=True, **KEYS)
    want = R.vector_topk(items.where("id < 400"), items, 4, skip_same=True, **KEYS)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, want.collect()))
    some = R.ann_topk(items, items, 4, centroids=centroids, probes=10, skip_same=True, **KEYS)
    near = R._unit(np.array([r.v for r in items.where("id < 400 and v[0] != 1").orderBy("id").collect()])) @ R._unit(centroids).T
    asked, home = np.argsort(-near, axis=1)[:, :10], near.argmax(axis=1)
    assert all(home[r.item_id] in asked[r.query_id] for r in some.collect() if 7 not in (r.query_id, r.item_id))
    assert max(copies) == 1
