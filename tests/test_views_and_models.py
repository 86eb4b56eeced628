"""Counts kept up by batches, mentions by automaton, the stored graph, saved classifiers."""

import random
from collections import Counter

from pyspark.sql import Observation
from pyspark.sql import functions as F

from docloom.operators import classify as C
from docloom.operators import graph as G
from docloom.sources import tables as ST
from docloom.streaming import counts as CV

GOLD = "id string, company string, tone string"


def counted(view):
    return {(r["company"], r["tone"]): r["n"] for r in view.read().collect()}


def test_counts_follow_inserts_deletes_and_replays(spark, tmp_path):
    draw = random.Random(3)
    view, rows = CV.CountView(spark, str(tmp_path / "v"), ["company", "tone"], "n", compact=3), {}
    for batch in range(8):
        new = {f"{batch}-{k}": (draw.choice(["a", "b", None]), draw.choice(["x", None])) for k in range(draw.randrange(5))}
        gone = dict(draw.sample(sorted(rows.items()), min(len(rows), draw.randrange(4))))
        signed = [(k, *v, 1) for k, v in new.items()] + [(k, *v, -1) for k, v in gone.items()]
        frame = spark.createDataFrame(signed, f"{GOLD}, {CV.SIGN} int")
        rows = {k: v for k, v in {**rows, **new}.items() if k not in gone}
        for _ in range(1 + batch % 2):  # some are delivered twice
            view.apply(frame, batch)
        assert counted(view) == Counter(rows.values())
    assert len(view._numbers("base")) == 1 and len(view._numbers("batch")) < 3
    view.apply(frame, 0)  # long since in the base
    assert counted(view) == Counter(rows.values())
    view.fold()
    assert counted(view) == Counter(rows.values()) and view._numbers("batch") == []


def test_a_base_without_its_mark_is_not_read(spark, tmp_path):
    view = CV.CountView(spark, str(tmp_path / "v"), ["company"], "n")
    for batch in range(2):
        view.apply(spark.createDataFrame([("a",)], "company string"), batch)
    (tmp_path / "v/base/1").mkdir(parents=True)
    assert [tuple(r) for r in view.read().collect()] == [("a", 2)]


def test_change_sets_become_signed_rows(spark, tmp_path):
    before = spark.createDataFrame([("1", "a", "x"), ("2", "a", "y"), ("3", "b", "x")], GOLD)
    after = spark.createDataFrame([("1", "a", "x"), ("2", "c", "y"), ("4", "b", "x")], GOLD)
    view = CV.CountView(spark, str(tmp_path / "v"), ["company", "tone"], "n")
    view.apply(before, 0)
    view.apply(CV.signed(before, after, ST.chunk_changes(before, after, "id"), "id"), 1)
    assert counted(view) == {("a", "x"): 1, ("c", "y"): 1, ("b", "x"): 1}


def brute_mentions(words, names):
    text = f" {' '.join(words)} "
    return sorted(n for n in names if n and f" {n} " in text)


def test_mentions_are_those_of_brute_force(spark, monkeypatch):
    draw = random.Random(8)
    word = lambda: draw.choice(["a", "b", "ab", "c", "é"])
    names = sorted({" ".join(word() for _ in range(draw.randrange(1, 6))) for _ in range(80)})
    texts = [[word() for _ in range(draw.randrange(40))] + ["unknown"] + [word() for _ in range(5)] for _ in range(60)] + [[], None]
    known = G.Mentions(names)
    for words in texts:
        assert known.found(words) == brute_mentions(words or [], names)
    assert G.Mentions([]).found(["a"]) == []
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, _words array<string>")
    named = spark.createDataFrame([(n,) for n in [*names, "", names[0]]], "_name string")
    want = sorted((i, n) for i, words in enumerate(texts) for n in brute_mentions(words or [], names))
    for size in (1 << 20, 200):
        monkeypatch.setattr(G, "NAME_BYTES", size)
        assert sorted(map(tuple, G.mentions(frame, named).collect())) == want


def test_long_names_cost_no_more_than_short_ones():
    import time

    words = ["a"] * 20_000

    def seconds(n):
        known = G.Mentions([" ".join(["a"] * k) for k in range(1, n)])
        start = time.process_time()
        known.found(words + ["b"])
        return time.process_time() - start

    one = G.Mentions([" ".join(["a"] * 5_000)])
    start = time.process_time()
    assert one.found(words) != [] and time.process_time() - start < 1
    assert seconds(10) < 1


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_the_stored_graph_answers_without_a_shuffle(spark):
    draw = random.Random(2)
    rows = {(f"s{draw.randrange(60)}", draw.choice("pq"), f"s{draw.randrange(60)}") for _ in range(400)}
    triples = spark.createDataFrame([("c", "f", *r, 1) for r in sorted(rows)], "company string, fiscal_period string, subject string, predicate string, object string, mention_count long")
    G.write_graph(triples, "probe_graph", 8)
    try:
        paths = G.stored_two_hop(spark, "probe_graph", "s1%", "p", ["q", "p"])
        assert exchanges(paths) == []
        assert sorted(map(tuple, paths.collect())) == sorted(map(tuple, G.two_hop(triples, "s1%", "p", ["q", "p"], limit=None).collect()))
        names = ["s1", "s7", "nobody"]
        want = G.entity_lookup_batch(triples, spark.createDataFrame([(n,) for n in names], "entity_name string"), limit=5)
        assert sorted(map(tuple, G.stored_lookup(spark, "probe_graph", names, 5).collect())) == sorted(map(tuple, want.collect()))
    finally:
        G.drop_graph(spark, "probe_graph")


def test_a_saved_classifier_scores_as_the_fitted_one(spark, tmp_path):
    rows = [(n, f"{'good fine' if n % 2 else 'bad poor'} text {n}", n % 2) for n in range(60)]
    labelled = spark.createDataFrame(rows, "id int, text string, label int")
    model = C.train_classifier(labelled)
    C.save_classifier(model, str(tmp_path / "m"))
    asked = spark.createDataFrame([(1, "a fine day"), (2, "poor work"), (3, None), (4, "")], "id int, text string")
    got = [tuple(r) for r in C.classify_with(asked, C.load_classifier(str(tmp_path / "m")), ["low", "high"]).orderBy("id").collect()]
    assert got == [tuple(r) for r in C.classify_with(asked, model, ["low", "high"]).orderBy("id").collect()]
    assert [r[2] for r in got[:3]] == ["high", "low", None] and got[3][2] in ("low", "high")


def test_a_fitted_classifier_scores_after_a_query_was_observed(spark):
    seen = Observation("seen")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 5}
    rows = [(n, f"{'good fine' if n % 2 else 'bad poor'} text {n}", n % 2) for n in range(60)]
    model = C.train_classifier(spark.createDataFrame(rows, "id int, text string, label int"))
    asked = spark.createDataFrame([(1, "a fine day"), (2, "poor work")], "id int, text string")
    assert [r.predicted for r in C.classify_with(asked, model, ["low", "high"]).orderBy("id").collect()] == ["high", "low"]
