import pytest
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.operators import classify as C
from docloom.operators import extract as X

ROOT = "/data/corpus/financial_docs_raw"


def fallback(spark, path, kind=None, company=None):
    df = spark.createDataFrame([(path, kind, company)], "source_path string, extracted_document_type string, extracted_company string")
    return X.fallback_columns(df).first()


@pytest.mark.parametrize(
    "path, extracted, expected",
    [
        (f"{ROOT}/8-K/globex-spring.txt", None, "8-K"),
        (f"{ROOT}/Board Minutes/umbra.html", None, "Board Minutes"),
        (f"{ROOT}/20-F/deep/er/initech.txt", None, "20-F"),
        (f"{ROOT}/8-K/globex-spring.txt", "Press Note", "Press Note"),
        ("/elsewhere/initech.txt", None, ""),
    ],
)
def test_document_type_fallback(spark, path, extracted, expected):
    assert fallback(spark, path, extracted).document_type == expected


@pytest.mark.parametrize(
    "name, extracted, expected",
    [
        ("Globex_spring.txt", None, "Globex"),
        ("Initech_19_report_b.html", None, "Initech"),
        ("Umbra.v2_final.txt", None, "Umbra"),
        ("Hooli.txt", None, "Hooli"),
        ("Globex_spring.txt", "Initech", "Initech"),
    ],
)
def test_company_fallback(spark, name, extracted, expected):
    assert fallback(spark, f"{ROOT}/10-K/{name}", company=extracted).company == expected


# The spellings a corpus uses and the names they stand for.
ALIASES = [
    ("amazon", "Amazon.com, Inc."), ("Amazon", "Amazon.com, Inc."), ("Amazon.com", "Amazon.com, Inc."), ("AMZN", "Amazon.com, Inc."),
    ("Apple", "Apple Inc."), ("AAPL", "Apple Inc."),
    ("Meta", "Meta Platforms, Inc."), ("Facebook", "Meta Platforms, Inc."),
    ("Microsoft", "Microsoft Corporation"), ("MSFT", "Microsoft Corporation"),
    ("NVIDIA", "NVIDIA Corporation"), ("Nvidia", "NVIDIA Corporation"), ("Nvidia Corp", "NVIDIA Corporation"), ("NVDA", "NVIDIA Corporation"),
]
MORE = [
    ("Meta Platforms, Inc.", "Meta Platforms, Inc."), ("microsoft-cloud results", "Microsoft Corporation"),
    ("Metaverse Holdings", None), ("Oracle", None), ("", None), (None, None),
]


@pytest.mark.parametrize("spelling, expected", ALIASES + MORE)
def test_canonicalize(spark, spelling, expected):
    df = spark.createDataFrame([(spelling,)], "x string")
    assert df.select(X.canonicalize("x")).first()[0] == expected


def test_canonical_names_are_the_five(spark):
    assert set(V.COMPANY_ALIASES.values()) == set(V.COMPANIES) and len(V.COMPANIES) == 5


def test_longest_alias_wins_and_table_form_agrees(spark, rows):
    aliases = {"alpha": "A", "alpha beta": "AB", "alpha beta gamma": "ABG"}
    names = [("Alpha",), ("ALPHA beta",), ("alpha-beta, delta",), ("alpha beta gamma inc",), ("alphabet",), (None,)]
    df = spark.createDataFrame(names, "x string")
    by_rule = rows(df.select("x", X.canonicalize("x", aliases)))
    table = spark.createDataFrame(list(aliases.items()), "alias string, canonical string")
    assert rows(X.canonicalize_by_table(df, "x", table)) == by_rule
    assert dict(by_rule) == {"Alpha": "A", "ALPHA beta": "AB", "alpha-beta, delta": "AB", "alpha beta gamma inc": "ABG", "alphabet": None, None: None}


def test_extract_fields_sentence(spark):
    text = "For the year ending on December, 2025, Microsoft took in $281 billion with a net of $101 billion"
    found = spark.createDataFrame([(text,)], "x string").select(X.extract_fields(F.col("x")).alias("f")).select("f.*")
    assert found.columns == V.FIELD_LABELS
    assert found.first().asDict() == {
        "company": "Microsoft", "fiscal_period": "December, 2025", "document_type": None,
        "revenue": "$281 billion", "net_income": "$101 billion",
    }


def test_extract_fields_filing(spark):
    text = "NVIDIA Corporation\n\nForm 10-K for FY24Q1\n\nRevenue was $100B, up from last year. Net income of $25B."
    got = spark.createDataFrame([(text,), (None,), ("nothing here",)], "x string").select(X.extract_fields(F.col("x")).alias("f")).select("f.*").collect()
    assert tuple(got[0]) == ("NVIDIA Corporation", "FY24Q1", "10-K", "$100B", "$25B")
    assert all(v is None for r in got[1:] for v in r)


def label(spark, text, labels, lexicon, default):
    return spark.createDataFrame([(text,)], "x string").select(C.classify("x", labels, lexicon, default)).first()[0]


def test_classify_scores_ties_and_defaults(spark):
    lexicon = {"a": {"red": 1, "dark": 3}, "b": {"blue": 2}}
    assert label(spark, "red red red", ["a", "b", "none"], lexicon, "none") == "a"
    assert label(spark, "red blue", ["a", "b", "none"], lexicon, "none") == "b"
    assert label(spark, "red red blue", ["a", "b", "none"], lexicon, "none") == "a"
    assert label(spark, "red red blue", ["b", "a", "none"], lexicon, "none") == "b"
    assert label(spark, "green", ["a", "b", "none"], lexicon, "none") == "none"
    assert label(spark, "", ["a", "b", "none"], lexicon, "none") == "none"
    assert label(spark, None, ["a", "b", "none"], lexicon, "none") is None


@pytest.mark.parametrize(
    "text, category",
    [
        ("We built datacenters full of GPUs.", "AI Infrastructure"),
        ("Copilot is our generative assistant.", "AI Products & Services"),
        ("A partnership and collaboration with a partner.", "AI Partnerships"),
        ("We sell shoes.", "Not AI-related"),
    ],
)
def test_default_categories(spark, text, category):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(C.ai_investment_category(T.tokens("x"))).first()[0] == category


def test_vocabularies():
    assert V.AI_CATEGORIES == ["AI Infrastructure", "AI Products & Services", "AI Partnerships", "Not AI-related"]
    assert V.MANAGEMENT_TONES == ["Positive", "Neutral", "Cautious", "Negative"]
    assert set(V.AI_CATEGORY_LEXICON) <= set(V.AI_CATEGORIES) and set(V.TONE_LEXICON) <= set(V.MANAGEMENT_TONES)


@pytest.mark.parametrize(
    "text, expected",
    [("good good", "positive"), ("bad", "negative"), ("good bad", "mixed"), ("good good bad", "mixed"),
     ("good good good bad", "positive"), ("so so", "neutral"), (None, None)],
)
def test_sentiment(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(C.sentiment("x", ["good"], ["bad"])).first()[0] == expected


def test_trained_classifier_keeps_the_contract(spark):
    train = spark.createDataFrame([("alpha beta", 1), ("alpha gamma", 1), ("delta", 0), ("delta beta", 0)] * 5, "text string, label int")
    docs = spark.createDataFrame([(1, "alpha"), (2, "delta"), (3, None)], "id int, text string")
    got = {r.id: r.predicted for r in C.classify_model(docs, train, ["no", "yes"]).collect()}
    assert got == {1: "yes", 2: "no", 3: None}
