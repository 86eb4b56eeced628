"""Source divergences against a plain count of all documents."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, docs int, term string, `own` string"


def brute(rows, least=3, top=200):
    """All divergences of rows (text, lang, source) as a set of (lang, source, part, item, value, rank)."""
    held, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        groups[lang].add(source)
        held[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        total = {s: sum(held[lang, s][t] for t in kept) for s in sources}
        share = lambda count, n, kept=kept: 1 + 10**9 * (count + 1) // (n + len(kept))
        p = {s: {t: share(held[lang, s][t], total[s]) for t in kept} for s in sources}
        q = {t: share(sum(held[lang, s][t] for s in sources), sum(total.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            told = {"pair": [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s], "term": [(t, f(p[s][t], q[t])) for t in kept if held[lang, s][t] and p[s][t] > q[t]]}
            for part, values in told.items():
                values.sort(key=lambda v: (-v[1], v[0].encode()))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(values, 1) if part == "pair" or k <= top}
    return out


def rows_of(n=400, seed=2):
    draw = np.random.default_rng(seed)
    words = ["a", "B", "été", "Ünï", "x" * 40, "don't", "中文", *(f"w{k}z{k}" for k in range(30)), *("n" + chr(97 + k) for k in range(26))]
    rows = []
    for _ in range(n):
        source = f"s{min(draw.geometric(0.35), 9)}"
        text = " ".join(words[k] for k in draw.zipf(1.4, draw.integers(0, 30)) % len(words))
        rows.append((text, ["en", "fr", None, "own"][draw.integers(0, 4)], source))
    return rows + [(None, None, None), ("", "xx", "only"), ("A-a a9A", "en", None), ("solo words", "yy", "s1"), (None, "yy", "s2"), ("A-a a9A", "en", None), ("q " * 50_000, "en", "s1")]


def docs_of(spark, rows):
    return spark.createDataFrame([(k, *r, 1, "t", "o") for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("limits", [{}, {"ENTRIES": 40, "GROUPS": 5, "SOURCES": 3, "CELLS": 12, "BLOCK_BYTES": 9}])
def test_divergences_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(divergence, name, value)
    rows = rows_of(120 if limits else 400)
    got = [tuple(r) for r in divergence.divergences(docs_of(spark, rows), top=5).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, top=5)


def test_empty_table(spark):
    assert divergence.divergences(docs_of(spark, [])).count() == 0


def test_shares_are_exact_beyond_63_bits():
    counts, total = np.array([0, 7, 2**60]), 2**61 + 3
    assert divergence.shares(counts, total).tolist() == [1 + 10**9 * (c + 1) // total for c in counts.tolist()]


def test_parts_of_a_stripe_are_folded():
    names = ["lang", "term", "docs", "sources", "counts"]
    rows = [("a", "t", 1, ["x"], [2]), ("a", "t", 2, ["y", "x"], [1, 5]), ("a", "u", 1, ["x"], [1]), ("b", "u", 1, [], []), ("b", "u", 4, ["z"], [9])]
    types = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
    out = divergence.merge_neighbours(pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names))
    told = [(r["lang"], r["term"], r["docs"], dict(zip(r["sources"], r["counts"], strict=True))) for r in out.to_pylist()]
    assert told == [("a", "t", 3, {"x": 7, "y": 1}), ("a", "u", 1, {"x": 1}), ("b", "u", 5, {"z": 9})]
