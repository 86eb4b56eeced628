import os

import pytest
from pyspark.sql import functions as F

from docloom import session as SS
from docloom.operators import summary as S
from docloom.plans import medallion as M
from docloom.plans import standin as D
from docloom.plans.workload import QUERIES
from docloom.sources import files as SF
from docloom.sources import tables as ST
from docloom.streaming import incremental as I

LONG = "Microsoft invested in datacenters and GPU clusters. Growth was strong. " * 6


def put(root, name, text):
    path = os.path.join(root, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)


def drop(spark, *names):
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_ingest_batch_and_inventory(spark, tmp_path):
    root = str(tmp_path / "financial_docs_raw")
    put(root, "10K/apple_2024.pdf", "a" * 100)
    put(root, "10K/deep/amazon_2024.pdf", "b" * 50)
    put(root, "10Q/meta.pdf", "c" * 10)
    put(root, "10Q/notes.txt", "d")
    files = SF.ingest_batch(spark, root, "*.pdf")
    assert files.columns == ["source_path", "content", "file_size_bytes", "ingested_at"]
    assert files.count() == 3
    inventory = SF.corpus_inventory(files)
    got = {r.folder: (r.files, r.megabytes, r.below_minimum) for r in inventory.collect()}
    assert got == {"10K": (1, 0.0001, False), "deep": (1, 0.00005, False), "10Q": (1, 0.00001, False), "TOTAL": (3, 0.00016, True)}
    assert "content" not in inventory._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_two_triggered_runs(spark, tmp_path):
    tables = [I.EVENT_LOG, "financial_docs_bronze", "financial_docs_silver", "financial_docs_gold", "company_ai_investment_summary", "financial_docs_for_search"]
    drop(spark, *tables)
    root, state = str(tmp_path / "financial_docs_raw"), str(tmp_path / "state")
    put(root, "10-K/Microsoft_FY24Q1.txt", LONG)
    put(root, "10-Q/Oracle_x.txt", LONG.replace("Microsoft", "Oracle"))
    put(root, "10-Q/short.txt", "too short")
    put(root, "10-Q/skipped.log", LONG)
    views = I.refresh(spark, root, "*.txt", state, fmt="text", min_rows=1, min_company=0.3)
    assert spark.table("financial_docs_bronze").count() == 3
    silver = {os.path.basename(r.source_path): r for r in spark.table("financial_docs_silver").collect()}
    assert set(silver) == {"Microsoft_FY24Q1.txt", "Oracle_x.txt"}
    assert spark.table("financial_docs_silver").columns == M.SILVER_COLUMNS
    first = silver["Microsoft_FY24Q1.txt"]
    assert (first.company, first.document_type) == ("Microsoft Corporation", "10-K") and silver["Oracle_x.txt"].company is None
    gold = {r.company: r for r in views["financial_docs_gold"].collect()}
    assert gold["Microsoft Corporation"].ai_investment_category == "AI Infrastructure" and "plain_text" not in views["financial_docs_gold"].columns
    before = spark.table("company_ai_investment_summary").agg(F.sum("document_count")).first()[0]

    put(root, "8-K/Apple_new.txt", LONG.replace("Microsoft", "Apple"))
    I.bronze_stream(spark, root, "*.txt", checkpoint=f"{state}/bronze")
    query = I.silver_stream(spark, checkpoint=f"{state}/silver", fmt="text")
    assert [m["input_rows"] for m in I.quality_metrics(query) if m["input_rows"]] == [1]
    views = I.refresh(spark, root, "*.txt", state, fmt="text", min_rows=1, min_company=0.3)
    assert spark.table("financial_docs_bronze").count() == 4 and spark.table("financial_docs_silver").count() == 3
    assert spark.table("company_ai_investment_summary").agg(F.sum("document_count")).first()[0] == before + 1
    chunks = spark.table("financial_docs_for_search")
    assert chunks.select("source_path").distinct().count() == 3
    assert {r[0]: r[1] for r in views["row_counts"].collect()}["financial_docs_silver"] == 3
    logged = spark.table(I.EVENT_LOG).where("name = 'input_rows'").agg(F.sum("value")).first()[0]
    assert logged == 3  # the third batch was logged by no refresh
    with pytest.raises(Exception, match="row count"):
        I.refresh(spark, root, "*.txt", state, fmt="text")
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES financial_docs_silver").collect()}
    assert properties["quality"] == "silver"
    drop(spark, *tables)


def test_expectation_metrics_of_a_stream(spark, tmp_path):
    drop(spark, "financial_docs_bronze", "financial_docs_silver")
    root, state = str(tmp_path / "financial_docs_raw"), str(tmp_path / "state")
    put(root, "10-K/Microsoft_1.txt", LONG)
    put(root, "10-K/short.txt", "x")
    I.bronze_stream(spark, root, "*.txt", checkpoint=f"{state}/bronze")
    query = I.silver_stream(spark, checkpoint=f"{state}/silver", fmt="text")
    metrics = I.quality_metrics(query)[0]
    assert metrics["input_rows"] == 2 and metrics["dropped_records"] == 1 and metrics["failed_has_fiscal_period"] == 2
    drop(spark, "financial_docs_bronze", "financial_docs_silver")


def test_run_batch_builds_every_table(spark, tmp_path):
    root = str(tmp_path / "financial_docs_raw")
    put(root, "10-K/Microsoft_1.html", f"<html><title>T</title><h1>H</h1><p>{LONG}</p></html>")
    put(root, "10-K/Apple_1.txt", LONG.replace("Microsoft", "Apple"))
    built = M.run_batch(SF.ingest_batch(spark, root), lambda df, name: SS.materialize(df, name), min_rows=1)
    assert {n: df.count() for n, df in built.items()} == {
        "financial_docs_silver": 2, "financial_docs_gold": 2, "company_ai_investment_summary": 2, "financial_docs_for_search": 3}
    page = built["financial_docs_for_search"].where(F.col("source_path").contains("Microsoft")).orderBy("chunk_id").collect()
    assert page[0].chunk_to_embed == "T\nPage 0\nT" and page[1].chunk_to_embed.startswith("T\nH\nPage 0\nH\n\nMicrosoft")


def test_overwrite_append_and_views(spark, rows):
    drop(spark, "t_over", "t_view")
    first = spark.createDataFrame([(1, "a")], "n int, s string")
    assert rows(ST.overwrite_table(first, "t_over")) == [(1, "a")]
    ST.append_by_name(spark.createDataFrame([("b", 2)], "s string, n int"), "t_over")
    assert rows(ST.read_table(spark, "t_over")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="extra"):
        ST.append_by_name(first.withColumn("extra", F.lit(1)), "t_over")
    assert rows(ST.overwrite_table(spark.createDataFrame([("z",)], "other string"), "t_over")) == [("z",)]
    view = ST.materialized_view(spark, "t_view", lambda: first, {"quality": "gold's"}, "a view")
    assert rows(view) == [(1, "a")] and rows(ST.materialized_view(spark, "t_view", lambda: first)) == [(1, "a")]
    drop(spark, "t_over", "t_view")


def test_parquet_folder_as_stream_source(spark, tmp_path, rows):
    drop(spark, "t_sink")
    source = str(tmp_path / "in")
    spark.range(3).write.parquet(source)
    for expected in (3, 3):
        ST.streaming_table(ST.read_stream_table(spark, source), "t_sink", str(tmp_path / "state"))
        assert spark.table("t_sink").count() == expected
    spark.range(3, 5).write.mode("append").parquet(source)
    ST.streaming_table(ST.read_stream_table(spark, source), "t_sink", str(tmp_path / "state"))
    assert rows(spark.table("t_sink")) == [(i,) for i in range(5)]
    drop(spark, "t_sink")


def test_scratch_folder_comes_from_the_session(spark):
    assert SS.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    kept = SS.materialize(spark.range(4).withColumn("r", F.rand()), "probe")
    assert kept.collect() == kept.collect()
    assert spark.conf.get("spark.checkpoint.dir") in kept.inputFiles()[0]


def test_clear_scratch_removes_only_its_own(spark):
    other = spark.range(2)
    other.write.mode("overwrite").parquet(f"{SS.scratch_root(spark)}/kept")
    SS.materialize(other, "gone")
    assert SS.clear_scratch(spark) and spark.read.parquet(f"{SS.scratch_root(spark)}/kept").count() == 2


def test_shuffle_partitions_follow_the_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    SS.configure(spark, shuffle_bytes=10 << 30)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 80
    SS.configure(spark, shuffle_bytes=1)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 80
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_to_a_path(spark, tmp_path, rows):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(3).write.parquet(source)
    ST.streaming_table(ST.read_stream_table(spark, source), sink, str(tmp_path / "state"))
    assert rows(ST.read_table(spark, sink, "id")) == [(0,), (1,), (2,)]


def test_summary_is_recomputed_from_gold(spark):
    gold = spark.createDataFrame([("A", "P", "T", "C", "S")] * 3, S.SUMMARY_KEYS)
    assert S.ordered_summary(S.investment_summary(gold)).first().document_count == 3


def files_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_only_buckets_of_changed_keys_are_rewritten(spark, tmp_path):
    old = spark.createDataFrame([(f"k{n}", f"text {n}") for n in range(200)], "chunk_id string, body string")
    new = spark.createDataFrame([("k3", "rewritten"), ("new", "come"), *((f"k{n}", f"text {n}") for n in range(4, 200))], "chunk_id string, body string")
    path = f"{tmp_path}/table"
    ST.write_bucketed(old, path, buckets=16)
    before = files_of(tmp_path / "table")
    changes = ST.chunk_changes(old, new)
    got = ST.apply_bucketed(spark, path, new, changes, buckets=16)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, new.collect()))
    touched = {f"bucket={b}" for b in ST.touched_buckets(changes, "chunk_id", 16)}
    after = files_of(tmp_path / "table")
    kept = {f for f in before if f.split("/")[0] not in touched}
    assert len(touched) <= 5 and kept
    assert all(after[f] == before[f] for f in kept)
    assert not any(f in after for f in before if f.split("/")[0] in touched)


def test_buckets_that_lose_all_rows_go(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{n}", "x") for n in range(20)], "chunk_id string, body string")
    path = f"{tmp_path}/table"
    ST.write_bucketed(rows, path, buckets=8)
    one = rows.where("chunk_id = 'k7'")
    got = ST.apply_bucketed(spark, path, one, ST.chunk_changes(rows, one), buckets=8)
    assert got.collect() == one.collect() and len({f.split("/")[0] for f in files_of(tmp_path / "table")}) == 1
    again = ST.apply_bucketed(spark, path, one, ST.chunk_changes(one, one), buckets=8)
    assert again.collect() == one.collect()


def test_silver_stream_reads_tables_of_one_file_and_of_many(spark, rows, tmp_path):
    docs = spark.createDataFrame([(k, f"The net of {k}\n\n{LONG}" if k % 5 else None, "en", "src1", 9) for k in range(20)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    turns = spark.createDataFrame([(k, 0, "user", f"asked {k} {LONG}") for k in range(5)], "conv_id long, turn int, role string, text string")
    columns = ["source_path", "file_size_bytes", "plain_text", "company", "fiscal_period"]
    for name, parts in (("folders", 3), ("files", 1)):
        root = tmp_path / name
        docs.repartition(parts).write.parquet(str(root / "documents.parquet"))
        turns.repartition(parts).write.parquet(str(root / "conversations.parquet"))
        if parts == 1:  # the one part in the place of its folder
            for table in ("documents", "conversations"):
                part = next((root / f"{table}.parquet").glob("part-*"))
                (root / "one").mkdir(exist_ok=True)
                (root / "one" / f"{table}.parquet").write_bytes(part.read_bytes())
            root = root / "one"
        got = QUERIES["silver_stream"](spark, str(root))
        assert rows(got, *columns) == rows(QUERIES["silver"](spark, str(root)), *columns)
        assert got.count() == 21


def test_text_files_are_one_a_row_in_folders_that_are_listed_side_by_side(spark, tmp_path):
    texts = [f"text {k}\nof two lines, ä" for k in range(2500)] + [None, "", "twice", "twice"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    folder = str(tmp_path / "files")
    assert D.write_text_files(rows, folder) == len(texts)
    read = SF.ingest_batch(spark, folder, "*.txt").select("content", "source_path", "file_size_bytes").collect()
    assert sorted(bytes(r["content"]).decode() for r in read) == sorted(f"{t or ''}\n" for t in texts)
    assert all(r["file_size_bytes"] == len(r["content"]) for r in read)
    assert max(len(names) for _, _, names in os.walk(folder)) <= 1000
    assert not [name for name in os.listdir(folder) if name.startswith("_")]


ODD_NAMES = ["a b.txt", "c%20d.txt", "ä{.txt", "x/y.txt", "x/_hidden.txt", "_folder/z.txt", ".folder/z.txt", "x/_k=1/w.txt", "e.log", "x/empty.txt", "x/a#b?c.txt"]


def read_files(files):
    return sorted((r.source_path, bytes(r.content), r.file_size_bytes) for r in files.collect())


@pytest.mark.parametrize("glob", [None, "*.txt", "{a,c}*", "[a-e]?*.txt"])
def test_files_listed_by_tasks_are_those_of_sparks_reader(spark, tmp_path, glob):
    root = str(tmp_path / "root dir")
    for name in ODD_NAMES:
        put(root, name, "" if "empty" in name else name)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    wanted = SF._bronze((reader.option("pathGlobFilter", glob) if glob else reader).load(root))
    files = SF.ingest_batch(spark, root, glob)
    assert read_files(files) == read_files(wanted) and files.count() >= 3
    assert "binaryFile" not in files._jdf.queryExecution().toString()  # whose listing lies in the driver
    assert read_files(SF.ingest_batch(spark, f"file://{root}", glob)) == read_files(wanted)
    assert read_files(SF.ingest_batch(spark, f"{root[:-3]}*", glob)) == read_files(wanted)


def test_contents_are_read_some_at_a_time(spark, tmp_path, monkeypatch):
    for n in range(50):
        put(str(tmp_path / "in"), f"{n}.txt", f"{n}" * 10)
    monkeypatch.setattr(SF, "READ_BYTES", 25)
    files = SF.ingest_batch(spark, str(tmp_path / "in"))
    assert sorted(bytes(r.content).decode() for r in files.collect()) == sorted(f"{n}" * 10 for n in range(50))
    assert files.where(F.length("content") == 20).count() == 40


def test_a_stream_of_manifests_delivers_each_file_once(spark, tmp_path):
    root, manifests = str(tmp_path / "in"), str(tmp_path / "manifests")
    for n in range(23):
        put(root, f"{n % 3}/{n}.txt", f"text {n}")

    def run(name):
        files = SF.ingest_stream(spark, root, "*.txt", 5, manifests)
        query = ST.streaming_table(files, f"{tmp_path}/{name}", f"{tmp_path}/{name}.state")
        return read_files(spark.read.parquet(f"{tmp_path}/{name}")), query

    def wanted():
        return read_files(SF.ingest_batch(spark, root, "*.txt"))

    got, query = run("one")
    assert got == wanted() and len(got) == 23
    assert max(p.numInputRows for p in query.recentProgress) <= 5
    assert run("one")[0] == wanted()
    put(root, "1/late.txt", "late")
    put(root, "1/other.log", "not asked for")
    assert run("one")[0] == wanted() and len(wanted()) == 24
    assert run("two")[0] == wanted()  # another checkpoint gets all
    log = os.path.join(tmp_path, "two.state", "sources", "0")
    assert not any(".txt" in open(os.path.join(log, name)).read() for name in os.listdir(log) if not name.startswith("."))


def test_shuffle_partitions_follow_the_tables(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.createDataFrame([(1, "s", 2.0)], "s_suppkey int, s_name string, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    with open(tmp_path / "lineitem.parquet", "wb") as held:
        held.truncate(80 << 20)  # 1280 MB of rows: ten partitions of 128 MB
    try:
        assert QUERIES["read_table"](spark, str(tmp_path)).count() == 1
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_chunk_revision_builds_no_index(spark, tmp_path):
    docs = [(n, f"Line {n} one.\n" + "Line two of it. " * 40, "en", f"src{n}", 30) for n in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, 0, "user", "Hello there. " * 40)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    synced = QUERIES["apply_changes"](spark, str(tmp_path)).collect()
    assert len(synced) == len({r.chunk_id for r in synced}) == 6  # one document is gone, one call has come
    assert sum(r.chunk_to_embed.endswith("(revised)") for r in synced) == 1
    assert not [key for key in D._INDEXES if key[1] == str(tmp_path)]
