"""Incremental builds: files to bronze to silver, then the recomputed views.

The streams are stateless maps, so they need no watermark and no state store;
exactly-once delivery comes from the source log and the sink's commit log.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.operators import quality as Q
from docloom.operators import summary as S
from docloom.plans import medallion as M
from docloom.sources.files import ingest_stream
from docloom.sources.tables import materialized_view, read_stream_table, streaming_table

OBSERVATION = "silver_quality"
#: Finished micro-batches that a run's handle remembers; more are an error, never a shorter list.
KEPT_BATCHES = 100_000
EVENT_LOG = "docloom_event_log"
RETENTION = "spark.sql.streaming.numRecentProgressUpdates"


def bronze_stream(spark: SparkSession, path: str, glob: str = "*.pdf", table: str = "financial_docs_bronze", *,
                  checkpoint: str) -> StreamingQuery:
    """Append files not seen before to the bronze table."""
    return streaming_table(ingest_stream(spark, path, glob), table, checkpoint, {"quality": "bronze"},
                           "Raw content of each document file, one row per file")


def silver_stream(spark: SparkSession, source: str = "financial_docs_bronze", table: str = "financial_docs_silver", *,
                  checkpoint: str, **options) -> StreamingQuery:
    """Append newly arrived bronze rows to silver, counting expectation failures per batch."""
    spark.conf.set(RETENTION, KEPT_BATCHES)
    rows = M.silver(read_stream_table(spark, source), observe_as=OBSERVATION, **options)
    return streaming_table(rows, table, checkpoint, {"quality": "silver"}, "Parsed documents with extracted fields")


def quality_metrics(query: StreamingQuery, observation: str = OBSERVATION) -> list[dict]:
    """Expectation counts of each finished micro-batch; raises if the handle has forgotten any."""
    found, progresses = [], query.recentProgress
    if progresses and len(progresses) >= KEPT_BATCHES:
        raise ValueError("more micro-batches than the run remembers; take in fewer files a run")
    for progress in progresses:
        metrics = progress.observedMetrics.get(observation)
        if metrics is not None:
            found.append({"batch_id": progress.batchId, **metrics.asDict()})
    return found


def log_metrics(spark: SparkSession, query: StreamingQuery, table: str = EVENT_LOG) -> None:
    """Append a run's expectation counts to the event log, one row per batch and count."""
    rows = [(str(query.runId), m["batch_id"], k, int(v)) for m in quality_metrics(query) for k, v in m.items() if k != "batch_id"]
    events = spark.createDataFrame(rows, "run_id string, batch_id long, name string, value long")
    events.withColumn("logged_at", F.current_timestamp()).write.mode("append").saveAsTable(table)


def refresh(spark: SparkSession, path: str, glob: str, checkpoints: str,
            gold: Callable[[DataFrame], DataFrame] = M.gold, min_rows: int = 50, min_company: float = 0.8,
            **options) -> dict[str, DataFrame]:
    """One triggered run: ingest what is new, log its expectation counts, recompute the views, enforce the gate.

    ``row_counts`` among the results has the number of rows of each table.
    """
    bronze_stream(spark, path, glob, checkpoint=f"{checkpoints}/bronze")
    log_metrics(spark, silver_stream(spark, checkpoint=f"{checkpoints}/silver", **options))
    silver = spark.read.table("financial_docs_silver")
    views = {"financial_docs_silver": silver}
    views["financial_docs_gold"] = materialized_view(spark, "financial_docs_gold", lambda: gold(silver), {"quality": "gold"})
    views["company_ai_investment_summary"] = materialized_view(
        spark, "company_ai_investment_summary", lambda: S.investment_summary(views["financial_docs_gold"]), {"quality": "gold"}
    )
    views["financial_docs_for_search"] = materialized_view(
        spark, "financial_docs_for_search", lambda: M.chunks(silver), {"quality": "gold"}
    )
    Q.enforce_gate(Q.quality_gate(silver, views["financial_docs_gold"], min_rows, min_company))
    views["row_counts"] = S.table_counts(views)
    return views
