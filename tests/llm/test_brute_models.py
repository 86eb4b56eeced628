"""The three learned operators against plain-Python versions of their scores."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from docloom.llm import language, quality, toxicity
from docloom.llm.arrays import WordHasher

MASK = (1 << 64) - 1
TEXTS = [None, "", "12 !", "The cat sat on the mat", "die Katze und der Hund", "é à ç l'été", "AB ab\ncd  ef ab", "the " * 300, "ein zwei drei vier fünf", "idiot fool idiot", "a b a b c\td"]


def gram_place(codes, order, buckets):
    value = 0
    for k, c in enumerate(codes):
        value = c if not k else (value * 0x100000001B3 + c) & MASK
    return ((value + (order << 56)) & MASK) * int(language.MULTIPLIER) % (1 << 64) >> (65 - buckets.bit_length())


def places_of(text, buckets):
    codes = [ord(c) if c.isalpha() else 32 for c in (text or "").lower()]
    return [gram_place(codes[i : i + n], n, buckets) for n in range(1, language.ORDERS + 1) for i in range(len(codes) - n + 1) if codes[i] != 32]


@pytest.mark.parametrize("block", [256, 2, 1])
def test_naive_bayes(spark, monkeypatch, block):
    monkeypatch.setattr(language, "BLOCK_LANGS", block)
    told = [(n, t, lang) for n, (t, lang) in enumerate([("the cat and the dog", "en"), ("on the mat", "en"), ("der Hund und die Katze", "de"), ("zwei drei", "de"), ("l'été à la mer", "fr"), ("ça et là", "fr"), ("uno dos tres", "es")])]
    model = language.fit(spark.createDataFrame(told, "doc_id long, text string, lang string"))
    buckets, langs = language.BUCKETS, sorted({lang for *_, lang in told})
    counts = {lang: Counter(p for _, t, own in told if own == lang for p in places_of(t, buckets)) for lang in langs}
    size = {lang: sum(counts[lang].values()) + language.SMOOTHING * buckets for lang in langs}
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in language.predict(docs, model).collect():
        text = TEXTS[row["doc_id"]]
        logs = {lang: math.log(sum(o == lang for *_, o in told) / len(told)) + sum(math.log((counts[lang][p] + language.SMOOTHING) / size[lang]) for p in places_of(text, buckets)) for lang in langs}
        best = max(logs, key=lambda x: (logs[x], -langs.index(x)))
        if not any(c.isalpha() for c in text or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        assert row["lang_pred"] == best
        assert row["score"] == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-3)


def brute_share(text):
    words = (text or "").encode().split()
    return len(set(words)) / len(words) if words else 1.0


def test_shares_of_distinct_words_look_at_whole_words():
    texts = [*TEXTS, "longwordA longwordB longwordA", "x" * 40 + "1 " + "x" * 40 + "2", " lead and trail "]
    data, offsets = quality.text_bytes(pa.array(texts))
    found = quality.distinct_share(data, offsets, WordHasher(quality.chunk_table()))
    assert found.tolist() == pytest.approx([brute_share(t) for t in texts])


def test_attention_net():
    draw = np.random.default_rng(4)
    net = quality.Net({k: draw.normal(size=v.shape) * 0.4 for k, v in quality.Net.fresh(0.1).w.items()})
    data, offsets = quality.text_bytes(pa.array([t or "" for t in TEXTS] + ["word one. " * 700]))
    x, first = quality.passages(data, offsets, quality.class_table(), WordHasher(quality.chunk_table()))
    got, w = net.forward(x, first)["p"], net.w
    assert first[-1] - first[-2] == 7  # passages of a long text
    for n in range(len(first) - 1):
        bag = [[math.tanh(sum(a * b for a, b in zip(row, column, strict=True)) + c) for column, c in zip(w["enc"].T, w["enc0"], strict=True)] for row in x[first[n] : first[n + 1]].tolist()]
        gate = []
        for h in bag:
            v = [math.tanh(sum(a * b for a, b in zip(h, column, strict=True)) + c) for column, c in zip(w["v"].T, w["v0"], strict=True)]
            u = [1 / (1 + math.exp(-sum(a * b for a, b in zip(h, column, strict=True)) - c)) for column, c in zip(w["u"].T, w["u0"], strict=True)]
            gate.append(sum(a * b * c for a, b, c in zip(w["a"], v, u, strict=True)))
        share = [math.exp(g - max(gate)) for g in gate]
        mean = [sum(s * h[k] for s, h in zip(share, bag, strict=True)) / sum(share) for k in range(len(bag[0]))]
        assert got[n] == pytest.approx(1 / (1 + math.exp(-sum(a * b for a, b in zip(mean, w["out"], strict=True)) - w["out0"][0])), abs=1e-5)


def brute_ftrl(rows, labels):
    """Weights by coordinate: FTRL-proximal over the rows' feature sets in mini-batches, one coordinate after the other."""
    seen = Counter(f for row in rows for f in row)
    kept = [sorted(f for f in row if seen[f] >= toxicity.LEAST_DOCS) for row in rows]
    z, n = Counter(), Counter()
    rare = max(1.0, toxicity.BALANCE * (len(labels) - sum(labels)) / sum(labels))

    def weight(f):
        shrunk = math.copysign(max(abs(z[f]) - toxicity.L1 * (f != "bias"), 0.0), z[f])
        return -shrunk / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    own = np.array([sum(row) & MASK for row in kept], np.uint64)
    order = np.argsort(toxicity.mix(own), kind="stable")
    for _ in range(toxicity.PASSES):
        for low in range(0, len(order), toxicity.BATCH_ROWS):
            slope, at = Counter(), {}
            for i in order[low : low + toxicity.BATCH_ROWS]:
                features = [*kept[i], "bias"]
                at.update({f: weight(f) for f in features if f not in at})
                p = 1 / (1 + math.exp(-sum(at[f] for f in features)))
                for f in features:
                    slope[f] += (p - labels[i]) * (rare if labels[i] else 1.0)
            for f, w in at.items():
                sigma = (math.sqrt(n[f] + slope[f] ** 2) - math.sqrt(n[f])) / toxicity.ALPHA
                z[f] += slope[f] - sigma * w
                n[f] += slope[f] ** 2
    return {f: weight(f) for f in [*z]}


def feature_set(text):
    _, _, _, words, first = WordHasher().words(pa.array([text]))
    return set(toxicity.features(words, first)[0].tolist())


def test_ftrl(spark):
    draw = np.random.default_rng(7)
    vocabulary = ["fine", "good", "idiot", "fool", "day", "walk", "you", "the"]
    texts = [" ".join(draw.choice(vocabulary, 12)) for _ in range(120)]
    labels = [int("idiot fool" in t or "you idiot" in t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    keys, weights, bias = model = toxicity.fit_on(docs, told)
    want = brute_ftrl([feature_set(t) for t in texts], labels)
    got = dict(zip(keys.tolist(), weights.tolist(), strict=True)) | {"bias": bias}
    assert got.keys() - {"bias"} == {f for f, w in want.items() if w and f != "bias"} and 0 < len(keys) < len({f for t in texts for f in feature_set(t)})
    for f, w in got.items():
        assert w == pytest.approx(want[f], abs=1e-6)
    for row in toxicity.score(docs, model).collect():
        total = sum(got.get(f, 0.0) for f in feature_set(row["text"])) + bias
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
