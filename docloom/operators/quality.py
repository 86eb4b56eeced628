"""Declared expectations, their report, and the run gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V


@dataclass(frozen=True)
class Expectation:
    """A named predicate; rows failing it (or NULL on it) are dropped or warned about."""

    name: str
    predicate: str
    action: str = "warn"

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


SILVER_EXPECTATIONS = [
    Expectation("has_content", f"plain_text IS NOT NULL AND length(plain_text) > {V.MIN_CONTENT_CHARS}", "drop"),
    Expectation("has_company", "company IS NOT NULL"),
    Expectation("has_doc_type", "document_type IS NOT NULL"),
    Expectation("has_fiscal_period", "fiscal_period IS NOT NULL"),
]


class QualityGateError(ValueError):
    """Raised when a gate check fails."""


def _kept(expectations: list[Expectation]) -> Column:
    kept = F.lit(True)
    for e in expectations:
        if e.action == "drop":
            kept = kept & e.holds()
    return kept


def expect_or_drop(df: DataFrame, *expectations: Expectation) -> DataFrame:
    """Rows that satisfy every dropping expectation given."""
    for e in expectations:
        df = df.where(e.holds())
    return df


def expect_warn(df: DataFrame, *expectations: Expectation) -> DataFrame:
    """All rows, with one boolean column per expectation."""
    return df.withColumns({e.name: e.holds() for e in expectations})


def apply_expectations(df: DataFrame, expectations: list[Expectation], observe_as: str | None = None) -> DataFrame:
    """Drop what must be dropped; count failures on the way when ``observe_as`` is set.

    The counts ride along with the scan as an observation, in batch and stream.
    """
    if observe_as:
        kept = _kept(expectations)
        df = df.observe(
            observe_as,
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(~kept).alias("dropped_records"),
            *[F.count_if(~e.holds()).alias(f"failed_{e.name}") for e in expectations],
        )
    return expect_or_drop(df, *[e for e in expectations if e.action == "drop"])


def expectation_report(df: DataFrame, expectations: list[Expectation] | None = None) -> DataFrame:
    """passed / failed / dropped / warned per expectation, from one aggregate.

    A warning counts only on rows that no dropping expectation removed.
    """
    expectations = SILVER_EXPECTATIONS if expectations is None else expectations
    kept = _kept(expectations)

    def counts(e: Expectation) -> Column:
        seen = F.lit(True) if e.action == "drop" else kept
        failed = F.count_if(seen & ~e.holds())
        none = F.lit(0).cast("bigint")
        return F.struct(
            F.lit(e.name).alias("expectation"),
            F.lit(e.action).alias("action"),
            F.count_if(seen & e.holds()).alias("passed"),
            failed.alias("failed"),
            (failed if e.action == "drop" else none).alias("dropped"),
            (failed if e.action == "warn" else none).alias("warned"),
        )

    return df.agg(F.array(*[counts(e) for e in expectations]).alias("report")).select(F.inline("report"))


def completeness(df: DataFrame, *columns: str) -> DataFrame:
    """total, non-null, missing and ratio per column, from one aggregate."""
    total = F.count(F.lit(1))

    def counts(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            total.alias("total"),
            F.count(name).alias("present"),
            (total - F.count(name)).alias("missing"),
            F.round(F.try_divide(F.count(name).cast("double"), total.cast("double")), 6).alias("ratio"),
        )

    return df.agg(F.array(*[counts(c) for c in columns]).alias("report")).select(F.inline("report"))


def quality_gate(silver: DataFrame, gold: DataFrame, min_rows: int = 50, min_company: float = 0.8) -> DataFrame:
    """The run gate as rows ``(check_name, passed, value)``.

    Each table is aggregated once to one row; the two rows meet in a sum.
    """
    zero = F.lit(0).cast("bigint")
    facts = (
        silver.agg(F.count(F.lit(1)).alias("silver_rows"), F.count("company").alias("named"))
        .withColumn("gold_rows", zero)
        .unionByName(gold.agg(F.count(F.lit(1)).alias("gold_rows")).withColumns({"silver_rows": zero, "named": zero}))
        .agg(F.sum("silver_rows").alias("silver_rows"), F.sum("named").alias("named"), F.sum("gold_rows").alias("gold_rows"))
    )
    ratio = F.coalesce(F.try_divide(F.col("named").cast("double"), F.col("silver_rows").cast("double")), F.lit(0.0))

    def check(name: str, passed: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"),
                        F.round(value.cast("double"), 6).alias("value"))

    rows = F.array(
        check(f"silver row count >= {min_rows}", F.col("silver_rows") >= min_rows, F.col("silver_rows")),
        check(f"silver company completeness >= {min_company:.0%}", ratio >= min_company, ratio),
        check("gold row count == silver row count", F.col("gold_rows") == F.col("silver_rows"), F.col("gold_rows")),
    )
    return facts.select(F.inline(rows))


def enforce_gate(gate: DataFrame) -> None:
    """Raise when any check of ``quality_gate`` failed (three rows reach the driver)."""
    failed = [row["check_name"] for row in gate.where(~F.col("passed")).collect()]
    if failed:
        raise QualityGateError(f"quality checks failed: {failed}")


def pk_duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def flow_progress(log: DataFrame, limit: int = 50) -> DataFrame:
    """Data-quality part of an event log ``(timestamp, event_type, details JSON)``, latest first."""
    quality = "$.flow_progress.data_quality"

    def read(field: str, kind: str) -> Column:
        return F.try_variant_get("_details", f"{quality}.{field}", kind)

    rows = log.where(F.col("event_type") == "flow_progress")
    return (
        T.compute_once(rows, _details=F.try_parse_json("details"))
        .select(
            "timestamp",
            read("dropped_records", "bigint").alias("dropped"),
            read("warned_records", "bigint").alias("warned"),
            read("expectations", "string").alias("expectations"),
        )
        .where(F.col("expectations").isNotNull())
        .orderBy(F.desc("timestamp"), "dropped", "warned", "expectations")
        .limit(limit)
    )
