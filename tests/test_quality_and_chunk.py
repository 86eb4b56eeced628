import pytest
from pyspark.sql import functions as F

from docloom.operators import chunk as K
from docloom.operators import parse as P
from docloom.operators import quality as Q
from docloom.operators import summary as S


def test_has_content_boundary(spark):
    df = spark.createDataFrame([("ok", "x" * 201), ("null", None), ("short", "too short"), ("edge", "x" * 200)], "id string, plain_text string")
    assert [r.id for r in Q.expect_or_drop(df, Q.SILVER_EXPECTATIONS[0]).collect()] == ["ok"]


def test_expectation_report_and_observation(spark, rows):
    from pyspark.sql import Observation

    df = spark.createDataFrame(
        [("x" * 300, "A", "10-K", None), ("x" * 300, None, "10-K", "Q1"), ("short", None, None, None)],
        "plain_text string, company string, document_type string, fiscal_period string",
    )
    report = {r.expectation: r for r in Q.expectation_report(df).collect()}
    assert (report["has_content"].passed, report["has_content"].dropped) == (2, 1)
    assert (report["has_company"].passed, report["has_company"].warned) == (1, 1)
    assert report["has_doc_type"].failed == 0
    seen = Observation("q")
    kept = df.observe(seen, F.count(F.lit(1)).alias("n"))
    assert Q.apply_expectations(kept, Q.SILVER_EXPECTATIONS, "silver").count() == 2
    assert seen.get["n"] == 3


def test_completeness(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "c string")
    assert tuple(Q.completeness(df, "c").first()) == ("c", 4, 2, 2, 0.5)
    assert Q.completeness(df.limit(0), "c").first().ratio is None


def test_gate(spark):
    silver = spark.createDataFrame([("A",)] * 9 + [(None,)], "company string")
    gate = {r.check_name: (r.passed, r.value) for r in Q.quality_gate(silver, silver, min_rows=10).collect()}
    assert gate["silver row count >= 10"] == (True, 10.0)
    assert gate["silver company completeness >= 80%"] == (True, 0.9)
    assert gate["gold row count == silver row count"] == (True, 10.0)
    Q.enforce_gate(Q.quality_gate(silver, silver, min_rows=10))
    with pytest.raises(Q.QualityGateError, match="gold row count"):
        Q.enforce_gate(Q.quality_gate(silver, silver.limit(3), min_rows=10))
    assert not Q.quality_gate(silver.limit(0), silver.limit(0)).collect()[1].passed


def test_flow_progress_reads_nested_details(spark):
    log = spark.createDataFrame(
        [
            (2, "flow_progress", '{"flow_progress":{"data_quality":{"dropped_records":1,"warned_records":2,"expectations":[{"name":"x"}]}}}'),
            (3, "flow_progress", '{"flow_progress":{}}'),
            (4, "other", '{"flow_progress":{"data_quality":{"expectations":"y"}}}'),
            (5, "flow_progress", "not json"),
        ],
        "timestamp int, event_type string, details string",
    )
    assert [tuple(r) for r in Q.flow_progress(log).collect()] == [(2, 1, 2, '[{"name":"x"}]')]


def chunks_of(spark, markup, size):
    df = P.parse_document(spark.createDataFrame([("doc", markup)], "source_path string, html string"), "html", "html")
    return K.chunk_documents(df, max_chars=size).collect()


def test_chunks_follow_sections_and_size(spark):
    markup = "<title>T</title><p>intro</p><h1>One</h1><p>aaaa</p><p>bbbb</p><p>cccc</p><h2>Two</h2><p>dd</p>"
    got = chunks_of(spark, markup, 7)
    assert [r.chunk_id for r in got] == [f"doc_chunk{i}" for i in range(4)]
    assert [r.chunk_text for r in got] == ["T\n\nintro", "One\n\naaaa", "bbbb\n\ncccc", "Two\n\ndd"]
    assert got[2].chunk_to_embed == "T\nOne\nPage 0\nbbbb\n\ncccc"
    assert got[0].chunk_to_embed == "T\nPage 0\nT\n\nintro"


def test_chunks_join_back_to_the_text(spark):
    lines = [("d%d" % n, "\n".join("w" * (1 + (n * i) % 37) for i in range(n * 7))) for n in range(1, 12)]
    df = P.parse_document(spark.createDataFrame(lines, "source_path string, text string"), "text", "text")
    parts = {}
    for r in K.chunk_documents(df, max_chars=50).collect():
        parts.setdefault(r.source_path, {})[int(r.chunk_id.rsplit("_chunk", 1)[1])] = r.chunk_text
    whole = {r.source_path: r[1] for r in df.select("source_path", P.plain_text("elements")).collect()}
    assert {k: "\n\n".join(v[i] for i in range(len(v))) for k, v in parts.items()} == whole
    assert K.duplicate_chunks(K.chunk_documents(df, max_chars=50)).count() == 0


def test_long_document_is_linear_work(spark):
    text = "\n".join(f"line {i}" for i in range(60_000))
    df = P.parse_document(spark.createDataFrame([("d", text)], "source_path string, text string"), "text", "text")
    assert K.chunk_documents(df, max_chars=1200).count() > 400


def test_empty_and_unparsed_documents_give_no_chunks(spark):
    df = P.parse_document(spark.createDataFrame([("a", ""), ("b", None)], "source_path string, text string"), "text", "text")
    assert K.chunk_documents(df).count() == 0


def test_duplicate_chunk_ids_are_found(spark):
    df = spark.createDataFrame([("doc1_chunk0",), ("doc1_chunk1",), ("doc1_chunk0",)], "chunk_id string")
    assert [tuple(r) for r in K.duplicate_chunks(df).collect()] == [("doc1_chunk0", 2)]


def test_search_table_has_seven_columns(spark):
    df = spark.createDataFrame([("p/a.pdf", "A", "Q1", "10-K", "hello", "$1")],
                               "source_path string, company string, fiscal_period string, document_type string, text string, revenue_reported string")
    got = K.search_table(P.parse_document(df, "text", "text"))
    assert got.columns == K.SEARCH_COLUMNS and got.count() == 1
    assert tuple(K.chunk_stats(got).first()) == (1, 1)


def test_summary_counts(spark):
    gold = spark.createDataFrame(
        [
            ("Apple", "FY24Q1", "10-K", "AI Infrastructure", "Positive"), ("Apple", "FY24Q1", "10-K", "AI Infrastructure", "Positive"),
            ("Apple", "FY24Q1", "10-K", "Not AI-related", "Neutral"), ("NVIDIA", "FY25Q1", "10-Q", "AI Infrastructure", "Positive"),
            ("NVIDIA", "FY25Q2", "10-Q", "AI Products & Services", "Positive"), (None, None, "10-Q", "Not AI-related", "Neutral"),
        ],
        S.SUMMARY_KEYS,
    )
    summary = S.investment_summary(gold)
    assert summary.columns == [*S.SUMMARY_KEYS, "document_count"]
    listed = S.summary_listing(summary).collect()
    assert [r.document_count for r in listed] == [2, 1, 1, 1]
    assert [r.company for r in listed] == ["Apple", "Apple", "NVIDIA", "NVIDIA"] and listed[2].fiscal_period == "FY25Q2"
    assert [tuple(r) for r in S.category_leaders(summary).collect()] == [("Apple", 2), ("NVIDIA", 1)]
    mix = {(r.company, r.ai_investment_category): r.pct_of_company for r in S.category_mix(gold).collect()}
    assert mix[("Apple", "AI Infrastructure")] == 66.7 and mix[("NVIDIA", "AI Infrastructure")] == 50.0
    counts = {r.table_name: r.row_count for r in S.table_counts({"gold": gold, "summary": summary}).collect()}
    assert counts == {"gold": 6, "summary": 5}


def test_run_history(spark):
    runs = spark.createDataFrame(
        [(1, 1_700_000_000_000, 1_700_000_125_900, "SUCCESS"), (2, 1_700_000_000_000, None, None), (3, 0, 0, "FAILED"),
         (4, 1_700_000_000_000, 1_700_000_000_000, "SUCCESS")],
        "run_id int, start_time bigint, end_time bigint, result_state string",
    )
    assert [tuple(r)[1:] for r in S.run_history(runs).orderBy("run_id").collect()] == [
        ("2023-11-14 22:13", "2m 5s", "SUCCESS"), ("2023-11-14 22:13", "—", "IN PROGRESS"),
        ("—", "—", "FAILED"), ("2023-11-14 22:13", "—", "SUCCESS"),
    ]
