"""Periodic runs against a brute-force search."""

import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as hs

from docloom.llm import queries, runs

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_runs string, RUNS int"


def brute(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q - start), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_rest(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(hs.lists(hs.builds(lambda head, part, times, tail: [w.encode() for w in head + (part * 30)[: len(part) * times + len(tail)] + tail], *(hs.text("abc", max_size=12) for _ in range(2)), hs.integers(0, 9), hs.text("ab", max_size=9)), max_size=4))
def test_runs_are_those_of_brute_force(texts):
    assert runs.runs_of(texts) == [brute(w) for w in texts]
    assert runs.runs_of(texts, 4, 3) == [brute(w, 4, 3) for w in texts]
    assert [runs.collapsed(w, brute(w)) for w in texts] == [brute_rest(w, brute(w)) for w in texts]


def test_long_repeats_and_nested_ones():
    row = [b"a", b"b"] * 5 + [b"c"]
    texts = [[b"x"] * 20_000, row * 900, [str(n).encode() for n in range(9_000)], (row * 6 + [b"z"]) * 5]
    got = runs.runs_of(texts)
    assert got[0] == [(0, 20_000, 1)] and got[2] == []
    assert got[1][0] == (0, 10, 2) and (0, 9_900, 11) in got[1] and len(got[1]) == 901
    assert got[3] == brute(texts[3])


def test_odd_rows(spark):
    rows = [(1, None, "x", 1), (1, "", "x", 1), (None, " \t\n", None, None), (2, "go " * 9 + "ok\x0bok", "x", 2), (2, "go " * 9 + "ok\x0bok", "x", 2), (3, "é\xa0b " * 7, "x", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = runs.periodic_runs(docs, text=True, digests=True)
    assert out.columns == ["doc_id", "text", "n_runs", "start", "length", "period", "runs", "collapsed", "runs_sha256", "collapsed_sha256"]
    got = sorted(((r["doc_id"] or 0, r["n_runs"], r["start"], r["length"], r["period"], r["collapsed"]) for r in out.collect()), key=str)
    none = (None, None, None, "")
    assert got == sorted([(1, 0, *none), (1, 0, *none), (0, 0, *none), *[(2, 1, 0, 9, 1, "go ok ok")] * 2, (3, 1, 0, 7, 1, "é\xa0b")], key=str)
    assert {r["runs_sha256"] for r in out.where("n_runs = 0").collect()} == {hashlib.sha256(b"").hexdigest()}
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.op13_runs(spark, SF).collect()}
    assert got.keys() == rows.keys() and sum(r["n_runs"] for r in got.values())
    for doc_id, text in rows.items():
        words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        want = (len(found), start, length, period, length * 1000 // period if found else None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(brute_rest(words, found)).hexdigest())
        assert tuple(got[doc_id])[1:] == want
