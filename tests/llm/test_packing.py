"""Packing against one-by-one best fit, and its ids against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from tokenizers import Tokenizer

from docloom.llm import packing, queries
from docloom.llm.bpe import read_text
from docloom.llm.packing import Capacity

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_chunks_give_the_ids_of_the_whole_text(library, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 40)
    draw = random.Random(5)
    signs = [" ", " ", " ", "\n", "\t", "\r\n", "\v", "a", "Hello", "'s", "it's", "don't", "1", "23", "é", "中", "🙂", "¿", "...", "!", "\xa0", "　", "\x1c", "\x85", " ", "<|end", "oftext|>", "<|endoftext|>", " the", "\x00"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(14))) for _ in range(4000)] + [None, "", " ", "word " * 3000, "x" * 5000]
    encoder = packing.ChunkEncoder(read_text(PATH))
    for low in range(0, len(texts), 300):
        part = texts[low : low + 300]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)]
        assert got == [library.encode(t or "", add_special_tokens=False).ids for t in part]


def one_by_one(lengths, capacity):
    """Number of sequences if every piece is placed by itself, longest first."""
    scale = np.array(capacity.weights) / capacity.whole.astype(float) ** 2
    left = []
    for n in sorted(lengths, reverse=True):
        need = capacity.needs(n)
        room = [k for k, r in enumerate(left) if (r >= need).all()]
        if capacity.rule == "norm":
            cost = lambda k, need=need: float(((left[k] - need) ** 2) @ scale)
        else:
            cost = lambda k, need=need: -float((left[k] * need) @ scale)
        k = min(room, key=cost) if room else len(left)
        if not room:
            left.append(capacity.whole.copy())
        left[k] = left[k] - need
    return len(left)


CAPACITIES = [Capacity(), Capacity(64, 64, 64 * 64), Capacity(64, 3, 64 * 64), Capacity(64, 64, 1500), Capacity(64, 5, 2000, (1.0, 0.5, 2.0)), Capacity(64, 4, 3000, rule="dot")]


@settings(max_examples=60, deadline=None)
@given(hs.lists(hs.integers(1, 38), max_size=80), hs.sampled_from(CAPACITIES))
def test_the_plan_keeps_every_capacity_and_is_best_fit(lengths, capacity):
    rows = packing.plan(Counter(lengths), capacity)
    bins = defaultdict(list)
    for length, first, per, many, start, used in rows.tolist():
        assert first == sum(len(x) for b in bins.values() for x in [[n for _, n in b if n == length]])
        for k in range(per * many):
            bins[start + k // per].append((used + k % per * length, length))
    assert Counter(n for b in bins.values() for _, n in b) == Counter(lengths)
    for held in bins.values():
        held.sort()
        assert [at for at, _ in held] == np.cumsum([0, *(n for _, n in held[:-1])]).tolist()
        total = sum(capacity.needs(n) for _, n in held)
        assert (total <= capacity.whole).all()
    assert sorted(bins) == list(range(len(bins)))
    want = one_by_one(lengths, capacity)
    assert len(bins) == want if capacity.rule == "norm" else abs(len(bins) - want) <= 1


def test_counts_of_any_size_take_no_longer():
    draw = np.random.default_rng(1)
    counts = {n: int(c) for n, c in enumerate(draw.geometric(1e-9, 2048), 1)}
    rows = packing.plan(counts)
    assert (rows[:, 2] * rows[:, 3]).sum() == sum(counts.values()) and len(rows) < packing.PLAN_ROWS
    tokens, used = sum(n * c for n, c in counts.items()), int((rows[:, 3] + rows[:, 4]).max())
    assert -(-tokens // 2048) <= used < tokens / 2048 * 1.02  # the pieces over half a sequence are the limit


def check_pieces(found, texts, library, longest):
    held, bins = defaultdict(list), defaultdict(list)
    for r in found:
        held[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert held.keys() == texts.keys()
    for doc_id, own in held.items():
        ids = [*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 0]
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // longest)))
        assert own[0]["length"] == (len(ids) - 1) % longest + 1 and all(r["length"] == longest for r in own[1:])
        at = 0
        for r in own:
            assert r["start"] == at
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    for rows in bins.values():
        rows.sort()
        assert [at for at, _ in rows] == np.cumsum([0, *(n for _, n in rows[:-1])]).tolist() and sum(n for _, n in rows) <= longest


def test_query_against_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.op12_packing(spark, SF).collect()
    check_pieces(found, texts, library, 2048)
    tokens = sum(r["length"] for r in found)
    assert len({r["sequence_id"] for r in found}) <= tokens / 2048 * 1.02 + 1


def test_odd_rows_and_sequences(spark, library):
    rows = [(1, None, "x", 9), (2, "", "x", 9), (None, "no id", "x", 9), (3, "one two three " * 40, "x", 9), (4, "word", None, None), (5, "a<|endoftext|>b  ", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, length int").repartition(3)
    packed = packing.pack(docs, PATH, Capacity(16, 16, 256), ids=True)
    found = packed.collect()
    check_pieces(found, {r[0]: r[1] for r in rows}, library, 16)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in found:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    again = docs.where("doc_id = 4").union(docs.where("doc_id = 4"))
    assert packing.pack(again, PATH).select("doc_id", "length", "sequence_id", "offset").orderBy("offset").collect() == [(4, 2, 0, 0), (4, 2, 0, 2)]
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_a_plan_needs_room_for_a_piece():
    with pytest.raises(ValueError):
        packing.plan({1: 1}, Capacity(0, 1, 1))
    with pytest.raises(ValueError):
        packing.plan({1: 1}, Capacity(rule="first"))
