"""SimHash, embedding and component operators against brute force."""

import math
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import embed_dedup, queries, simhash
from docloom.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def test_fingerprints():
    texts = ["", None, " \t", "One two", "a b c d", "A b\x0bc\xa0D e", "x " * 600, "é ñ É " * 50]
    assert simhash.fingerprints(texts)[0].tolist() == [brute_print(t) for t in texts]


def test_gray_rank_orders_neighbours():
    codes = np.arange(256, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(ordered[1:] ^ ordered[:-1]) == 1).all()


@settings(max_examples=30, deadline=None)
@given(hs.integers(0, 2**32), hs.integers(1, 12), hs.sampled_from([2, 4, 10]))
def test_index_finds_every_pair(seed, width, distance):
    draw = np.random.default_rng(seed)
    codes = np.unique(draw.integers(0, 2**63, 40, dtype=np.uint64)[draw.integers(0, 40, 900)] ^ (np.uint64(1) << draw.integers(0, 64, 900, dtype=np.uint64)) ^ draw.integers(0, 1 << width, 900, dtype=np.uint64))
    group = np.sort(draw.integers(0, 3, len(codes)))
    order = np.lexsort((simhash.gray_rank(codes), group))
    codes = codes[order]
    index = simhash.GrayIndex(codes, group, distance)
    found = {(int(a), int(b)) for x, y in index.pairs(0, len(codes)) for a, b in zip(x, y, strict=True)}
    near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance
    near &= group[:, None] == group[None, :]
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near, 1))), strict=True))


def test_every_near_pair_shares_a_key():
    draw = np.random.default_rng(5)
    for distance in (4, 10):
        for n in (10, 10**6, 10**9):
            blocks = simhash.block_count(n, distance)
            masks = simhash.key_masks(list(range(64)), blocks, distance)
            for _ in range(200):
                flips = sum(1 << int(b) for b in draw.choice(64, distance, replace=False))
                assert any(not flips & m for m in masks)


@pytest.mark.parametrize("hot", [10**6, 5])
def test_links_connect_what_brute_force_connects(spark, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_ROWS", hot)
    draw = np.random.default_rng(2)
    base = draw.integers(0, 2**63, 12, dtype=np.uint64)
    codes = {0}
    for code in base.tolist():
        for _ in range(8):
            codes.add(code ^ sum(1 << int(b) for b in draw.choice(63, draw.integers(0, 7), replace=False)))
    codes = sorted(codes)
    classes = spark.createDataFrame([(n, c, 0) for n, c in enumerate(codes)], "cid long, simhash long, simhash2 long")
    got = {r["node"]: r["label"] for r in components(simhash.links(classes)).collect()}
    want = groups(len(codes), [(a, b) for a in range(len(codes)) for b in range(a) if bin(codes[a] ^ codes[b]).count("1") <= 4])
    for a in range(len(codes)):
        for b in range(a):
            assert (want[a] == want[b]) == (got.get(a, -a - 1) == got.get(b, -b - 1))


def test_simhash_rows(spark):
    text = " ".join(f"w{n}" for n in range(300))
    rows = [(5, text, "x"), (3, text, "x"), (3, text, "x"), (9, text + " end", "x"), (7, None, "x"), (8, "", "x"), (None, " ", "x"), (4, "other words are here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, simhash string")
    got = sorted((r["doc_id"] or -1, r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert bin(brute_print(text) ^ brute_print(text + " end")).count("1") <= 4
    assert got == [(-1, 7), (3, 3), (3, 3), (4, 4), (5, 3), (7, 7), (8, 7), (9, 3)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_simhash_query_against_brute_force(spark):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    prints = [brute_print(t) for _, t in docs]
    label = groups(len(docs), [(a, b) for a in range(len(docs)) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 4])
    want = {(d, f"{p:016x}", docs[k][0]) for (d, _), p, k in zip(docs, prints, label, strict=True)}
    assert {tuple(r) for r in queries.op10_simhash(spark, SF).collect()} == want


def test_components_of_chains_stars_and_nothing(spark):
    links = [(n, n + 1) for n in range(0, 60)] + [(100, n) for n in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({got[n] for n in range(61)}) == len({got[n] for n in range(100, 140)}) == 1
    assert len(set(got.values())) == 3 and got[200] == got[201]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def planted(n, dims=32):
    draw = np.random.default_rng(4)
    rows = draw.standard_normal((n, dims))
    rows[: n // 3] = rows[n // 3 : 2 * (n // 3)] + draw.standard_normal((n // 3, dims)) * draw.uniform(0.05, 0.6, (n // 3, 1))
    return rows


def test_embedding_links_against_brute_force(spark):
    vectors = planted(900)
    rows = [(n, v.tolist(), n % 3) for n, v in enumerate(vectors)]
    rows += [(900, vectors[5].tolist(), 0), (901, (vectors[5] * 3).tolist(), 0), (901, vectors[5].tolist(), 0)]
    rows += [(902, None, 0), (903, [0.0] * 32, 0), (904, [float("nan")] * 32, 0), (905, [None] * 32, 0), (906, [], 0), (907, [1e300, -1e300], 0), (908, [1e-300, -1e-300], 0)]
    found = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")).collect()
    unit = np.vstack([vectors, vectors[5], vectors[5], vectors[5]])
    unit = unit / np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    many = near.sum(axis=1) - 1
    got = [r["n_links"] for r in found if r["vec_id"] < 902]
    assert len(found) == len(rows)
    assert sum(got) >= 0.9 * many.sum() and max(got) <= many.max()
    by_id = {r["vec_id"]: r for r in found}
    assert all(by_id[n]["n_links"] <= many[n] for n in range(900))
    assert all((by_id[n]["n_links"], by_id[n]["component_id"], by_id[n]["kept"]) == (0, n, True) for n in range(902, 907))
    assert by_id[907]["n_links"] == by_id[908]["n_links"] == 1 and by_id[908]["component_id"] == 907
    assert by_id[5]["n_links"] >= 3 and by_id[900]["component_id"] == by_id[901]["component_id"] == by_id[5]["component_id"]
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_calibrated_count_finds_pairs_at_the_threshold():
    for n in (10, 10_000, 10**7):
        planes, projections = embed_dedup.calibrate(n)
        draw = np.random.default_rng(n)
        x = np.array([1.0, 0.0])
        y = np.array([0.9, math.sqrt(1 - 0.81)])
        hits = 0
        for _ in range(400):
            r = draw.standard_normal((2, projections, planes + 1))
            a, b = np.tensordot(x, r, 1), np.tensordot(y, r, 1)
            same = ((a[:, 1:] > 0) == (b[:, 1:] > 0)).all(axis=1) & (np.abs(a[:, 0] - b[:, 0]) <= embed_dedup.WINDOW)
            hits += same.sum() >= embed_dedup.COUNT
        assert hits >= 0.93 * 400


def test_small_chunks_lose_no_collision(spark, monkeypatch):
    rows = [(n, v.tolist()) for n, v in enumerate(planted(300))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, embed_dedup.near_duplicates(vectors).collect()))
    monkeypatch.setattr(embed_dedup, "ROWS", 7)
    monkeypatch.setattr(embed_dedup, "PAIRS", 5)
    assert sorted(map(tuple, embed_dedup.near_duplicates(vectors).collect())) == whole


def test_either_fingerprint_may_be_the_nearer_one(spark):
    near, far = (1 << 10) - 1, (1 << 14) - 1
    codes = [(0, 0), (near, far), (1 << 40, 1 << 50 | far << 20), (1 << 40 | far << 20, 1 << 50 | near << 2 | far << 20)]
    classes = spark.createDataFrame([(n, a, b) for n, (a, b) in enumerate(codes)], "cid long, simhash long, simhash2 long")
    found = {r["node"]: r["label"] for r in components(simhash.links(classes, 10, 14)).collect()}
    assert found[0] == found[1] and found[2] == found[3] and found[0] != found[2]
    assert components(simhash.links(classes, 9, 14)).count() == 0


def test_the_stage_keeps_one_document_of_each_simhash_group(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(400)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    prints = [brute_print(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= simhash.DISTANCE]
    of = groups(len(rows), near)
    want = {min(rows[k][0] for k in range(len(rows)) if of[k] == g) for g in set(of)}
    stage = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    assert {r["doc_id"] for r in stage(spark, docs, None).collect()} == want
