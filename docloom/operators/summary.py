"""Aggregates over the gold table and run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V

SUMMARY_KEYS = ["company", "fiscal_period", "document_type", "ai_investment_category", "management_sentiment"]


def investment_summary(gold: DataFrame) -> DataFrame:
    """Documents per company, period, type, category and tone."""
    return gold.groupBy(*SUMMARY_KEYS).agg(F.count(F.lit(1)).alias("document_count"))


def ordered_summary(summary: DataFrame) -> DataFrame:
    """The summary as it is read: by company, then period. Stored tables keep no order."""
    return summary.orderBy(*SUMMARY_KEYS)


def summary_listing(summary: DataFrame) -> DataFrame:
    """Named companies, latest period first, biggest group first."""
    return (
        summary.where(F.col("company").isNotNull())
        .select("company", "fiscal_period", "ai_investment_category", "management_sentiment", "document_count")
        .orderBy("company", F.desc("fiscal_period"), F.desc("document_count"), "ai_investment_category", "management_sentiment")
    )


def category_mix(gold: DataFrame) -> DataFrame:
    """Documents per company and category with their share of the company's total."""
    per_company = Window.partitionBy("company")
    counted = gold.where(F.col("company").isNotNull()).groupBy("company", "ai_investment_category").agg(
        F.count(F.lit(1)).alias("document_count")
    )
    share = F.col("document_count") * 100.0 / F.sum("document_count").over(per_company)
    return counted.withColumn("pct_of_company", F.round(share.cast("double"), 1)).orderBy(
        "company", F.desc("document_count"), "ai_investment_category"
    )


def category_leaders(summary: DataFrame, category: str = V.AI_CATEGORIES[0]) -> DataFrame:
    """Companies ranked by their documents in one category."""
    return (
        summary.where(F.col("ai_investment_category") == category)
        .groupBy("company").agg(F.sum("document_count").alias("docs"))
        .orderBy(F.desc("docs"), "company")
    )


def category_by_company(summary: DataFrame) -> DataFrame:
    return (
        summary.where(F.col("ai_investment_category").isNotNull())
        .groupBy("company", "ai_investment_category").agg(F.sum("document_count").alias("total_docs"))
        .orderBy("company", F.desc("total_docs"), "ai_investment_category")
    )


def signals_for_companies(summary: DataFrame, companies: list[str]) -> DataFrame:
    """AI-related document totals of the given companies."""
    related = summary.where(F.col("company").isin(companies) & (F.col("ai_investment_category") != V.NOT_AI))
    return (
        related.groupBy("company", "ai_investment_category").agg(F.sum("document_count").alias("total_docs"))
        .orderBy("company", F.desc("total_docs"), "ai_investment_category")
    )


def analysis_rows(summary: DataFrame) -> DataFrame:
    """Summary rows (not documents) per company, period and category."""
    return summary.groupBy("company", "fiscal_period", "ai_investment_category").agg(F.count(F.lit(1)).alias("doc_count"))


def company_breakdown(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("company").isNotNull()).groupBy("company").agg(F.count(F.lit(1)).alias("docs")).orderBy("company")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def run_history(runs: DataFrame) -> DataFrame:
    """Readable start, duration and result of job runs given in epoch milliseconds."""
    started, ended = F.nullif("start_time", F.lit(0)), F.nullif("end_time", F.lit(0))
    seconds = (ended - started) / 1000.0
    return runs.select(
        "run_id",
        F.coalesce(F.date_format(F.timestamp_millis(started), "yyyy-MM-dd HH:mm"), F.lit("—")).alias("started"),
        T.duration_text(seconds).alias("duration"),
        F.coalesce("result_state", F.lit("IN PROGRESS")).alias("result"),
    )
