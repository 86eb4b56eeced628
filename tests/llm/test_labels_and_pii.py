"""Classifiers on held-out rows; personal data against brute force; the pipeline stage by stage."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import decontaminate, language, pii, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute_spans(text):
    return sorted((m.start(), n, m.end()) for n, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if good(kind, m[0]))


def odd_texts():
    rnd = random.Random(8)
    parts = ["a.b@c.d", "x@y.z_q@r.s", "1.2.3.4", "1.2.3.4.5", "256.1.1.1", "0001.2.3.04", "4111 1111 1111 1111", "4111-1111-1111-1112", "1 2-3", "+1 (784) 555-9263", "+12.", "é", "\U0001f600", " ", ",", "..", "@", "5", "-", "a", "\n"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(400)] + ["7" * 3000, "a" * 3000, "1 " * 3000, "a.b@c.d " * 600, None, ""]


def test_base_spans(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, base string")
    for row in pii.find(docs).collect():
        assert [(s["start"], s["kind_no"], s["end"]) for s in row["base"]] == brute_spans(texts[row["doc_id"]]), texts[row["doc_id"]]
    assert pii.find(docs.limit(0)).count() == 0


def test_pii_query_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = queries.op4_pii(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for row in rows:
        spans = brute_spans(docs[row["doc_id"]])
        told = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [row[f"n_{kind}"] for kind in BASE] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert row["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert set(filter(None, told.split(","))) <= set(row["spans"].split(","))


def test_bootstrap_discovers_what_patterns_share(spark):
    known = [(n, f"please write to contact address: user{n}@mail.example and wait", "x") for n in range(12)]
    hidden = [(100, "they said contact address: user77712345(at)mail and left", "x"), (101, "they said chapter 7771234567 and left", "x"), (102, "contact address: 12", "x")]
    found = {r["doc_id"]: r["extra"] for r in pii.find(spark.createDataFrame(known + hidden, "doc_id long, text string, extra string")).collect()}
    start = hidden[0][1].index("user77712345")
    assert [(s["start"], s["end"]) for s in found[100]] == [(start, start + len("user77712345(at)mail"))]
    assert not found[101] and not found[102] and not any(found[n] for n in range(12))


def test_running_totals_are_those_of_a_loop(spark):
    sizes = [0, 1, 2, 3, 10, 50]
    rows = spark.createDataFrame([(n, list(range(n))) for n in sizes], "n int, v array<long>")
    for row in pii.running(rows, "total", F.col("v"), F.lit(0).cast("long"), lambda a, b: a + b).collect():
        assert row["total"] == [sum(row["v"][:k]) for k in range(row["n"] + 1)]


def test_redaction(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    for row in pii.redact(docs, pii.find(docs)).collect():
        text, spans = texts[row["doc_id"]], brute_spans(texts[row["doc_id"]])
        want, at = "", 0
        for a, k, b in spans:
            if a >= at:
                want += text[at:a] + f"[{pii.KINDS[k].upper()}]"
            at = max(at, b)
        assert row["text"] == (None if text is None else want + text[at:])


@pytest.mark.parametrize(
    "known, hidden",
    [
        ("call 24 phone: {}", "call 24 phone: 55512345"),  # a digit token in front
        ("ids 1234567 {} end", "ids 1234567 2345678 end"),  # right behind another
        ("{1} passport: {0}", "zulu  passport:\n55512345"),  # a cue of one word
    ],
)
def test_contexts_are_read_from_the_text_in_front(spark, known, hidden):
    rows = [(n, known.format(f"+1 784 555 92{n}3", "word" + "abcdefgh"[n])) for n in range(8)] + [(9, hidden)]
    found = {r["doc_id"]: r["extra"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    value = next(v for v in ("55512345", "2345678") if v in hidden.split())
    assert (hidden.rindex(value), 4, hidden.rindex(value) + len(value)) in {tuple(s) for s in found[9]}


def held_out(rows, n):
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == (2 if n == 4 else 0)) for r in rows)
    return [r for r in rows if r["held_out"]]


def test_language(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op2_language(spark, SF).collect()
    assert len(rows) == len(langs) and all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held_out(rows, 4)]) > 0.97


def test_language_of_odd_texts(spark):
    rows = [(n, "the of and", "en", "x") for n in range(5)] + [(n, "der die und", "de", "x") for n in range(5)] + [(20, None, "en", "x"), (21, "12 !", None, "x"), (22, "", "de", "x"), (23, "THE OF " * 5000, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = {r["doc_id"]: r for r in language.predict(docs, language.fit(docs)).collect()}
    assert [found[n]["lang_pred"] for n in (20, 21, 22, 23)] == ["und", "und", "und", "en"]
    nothing = language.predict(docs, language.fit(docs.limit(0))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


@pytest.mark.parametrize("query, label, n", [("op3_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.9)])
def test_classifiers_on_held_out_rows(spark, query, label, n):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.QUERIES[query](spark, SF).collect()
    told = [(r["predicted"], labels[r["doc_id"]]) for r in held_out(rows, 5) if r["doc_id"] in labels]
    assert np.mean([a == b for a, b in told]) >= n and all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_rows(spark, module):
    rows = [(n, f"fine words here number{n} and more", "x") for n in range(30)] + [(n, "idiot %%% idiot $$$", "x") for n in range(30, 50)] + [(60, None, "x"), (60, "", "x"), (None, "a " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(n, int(n >= 30)) for n in range(50)] + [(1, None), (None, 1), (99, 0)], "doc_id long, y int")
    scored = module.score(docs, module.fit_on(docs, labels, "y")).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert min(r["score"] for r in scored if r["doc_id"] in range(30, 50)) > max(r["score"] for r in scored if r["doc_id"] in range(30))
    assert module.score(docs, module.fit_on(docs, labels.limit(0), "y")).count() == len(rows)
    assert module.score(docs.limit(0), module.fit_on(docs, labels, "y")).count() == 0


def test_gradient_of_the_attention_net():
    draw = np.random.default_rng(0)
    x, first, y = draw.random((7, quality.WIDTH)), np.array([0, 3, 4, 7]), np.array([1.0, 0.0, 1.0])
    net = quality.Net.fresh(0.3)

    def loss():
        p = net.forward(x, first)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, slope in net.gradient(x, first, y).items():
        weight, at = net.w[name], np.unravel_index(slope.size // 2, slope.shape)
        weight[at] += 1e-5
        high = loss()
        weight[at] -= 2e-5
        assert abs((high - loss()) / 2e-5 - slope[at]) < 1e-6
        weight[at] += 1e-5


# ---------------------------------------------------------- the pipeline ----
def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_keep_the_columns_and_their_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "bpe"]
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, SF).schema.simpleString() == docs.schema.simpleString()
        assert function(spark, docs.limit(0), SF).count() == 0


def test_stages_bear_any_column_names_and_rows(spark):
    rows = [(1, "one two three four five six", "x", 1, "k"), (1, "one two three four five six", "x", 1, "k"), (2, None, None, None, None), (3, "", "y", 2, "q"), (4, "mail me a@b.com", "z", 3, "r"), (None, "lonely", None, 4, "s"), (5, "word " * 20_000, "l", 5, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits string, `__spans` int, score string")
    docs = docs.withColumns({"rest": docs["hits"], "a.b": docs["score"], "id": docs["doc_id"], "key": docs["doc_id"], "n_tokens": docs["doc_id"]})
    for name, run in corpus_pipeline.STAGES:
        assert run(spark, docs.limit(0), SF).count() == 0
        before, docs = docs.columns, run(spark, docs, SF)
        assert docs.columns == before or name == "bpe"
    left = {r["doc_id"]: r for r in docs.collect()}
    assert left.keys() == {None, 1, 2, 4, 5} and (left[4]["hits"], left[4]["a.b"], left[2]["n_tokens"]) == ("z", "r", 0)


def test_copies_leave_one_of_each_group(spark):
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rnd.randrange(50)) for _ in range(400))
    near = text.replace(" ", " x ", 1)
    rows = [(4, text, "en", "s", 1), (2, near, "en", "s", 1), (2, near, "en", "s", 1), (9, None, "en", "s", 1), (8, "", "en", "s", 1), (None, text, "en", "s", 1), (7, "quite another text " * 9, "en", "s", 1), (7, "and one more of its kind " * 7, None, None, None)]
    kept = stage("simhash near-dedup")(spark, rows_of(spark, rows), SF).collect()
    assert sorted((r["doc_id"], (r["text"] or "")[:9]) for r in kept) == [(2, near[:9]), (7, "and one m"), (7, "quite ano"), (8, "")]


def test_contaminated_documents_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = {r["doc_id"] for r in decontaminate.contamination(docs, bench).where("n_hit > 0").collect()}
    kept = {r["doc_id"] for r in stage("benchmark decontamination")(spark, docs, SF).collect()}
    assert hit and kept == {r["doc_id"] for r in docs.collect()} - hit


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stage("toxicity")(spark, docs, SF).collect()}
    assert np.mean([d not in kept for d, t in toxic.items() if t]) > 0.7
    assert np.mean([d in kept for d, t in toxic.items() if not t]) > 0.98


def test_run_is_the_stages_one_after_the_other(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, function in corpus_pipeline.STAGES:
        out = function(spark, docs, "/root/testdata/sf0.001")
        docs = spark.createDataFrame(out.collect(), out.schema)
    whole = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_samples_are_bounded_whatever_repeats(spark):
    from docloom.llm.arrays import bounded_sample

    for rows in (spark.range(500), spark.range(500).selectExpr("id % 3 AS id"), spark.range(500).selectExpr("1 AS id")):
        assert bounded_sample(rows, 1000, "id").count() == 500
        assert 0 < bounded_sample(rows, 50, "id").count() <= 50
        assert bounded_sample(rows, 50, "id").count() == 50 or rows.distinct().count() < 50
