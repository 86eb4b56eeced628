"""Bronze to silver to gold to summary, as functions of their upstream table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.operators import classify as C
from docloom.operators import extract as X
from docloom.operators import parse as P
from docloom.operators import quality as Q
from docloom.operators import summary as S
from docloom.operators.chunk import search_table

SILVER_COLUMNS = [
    "source_path", "file_size_bytes", "ingested_at", "parsed_document", "plain_text", "company", "fiscal_period",
    "document_type", "revenue_reported", "net_income_reported",
]


def silver_rows(bronze: DataFrame, *, fmt: str = "auto", rules=None, aliases: dict[str, str] | None = None,
                root: str = V.RAW_ROOT) -> DataFrame:
    """Parsed documents with extracted fields, before expectations (adds ``elements``)."""
    parsed = P.parse_document(bronze, "content", fmt)
    parsed = T.compute_once(parsed, plain_text=P.plain_text("elements"))
    parsed = T.compute_once(parsed, extracted=X.extract_fields(F.col("plain_text"), rules=rules))
    path = F.col("source_path")
    kind = X.document_type_or_folder(F.col("extracted.document_type"), path, root)
    company = X.company_or_file_prefix(F.col("extracted.company"), path)
    return parsed.select(
        "source_path",
        "file_size_bytes",
        "ingested_at",
        P.to_variant(F.col("elements")).alias("parsed_document"),
        "plain_text",
        X.canonicalize(company, aliases).alias("company"),
        F.col("extracted.fiscal_period").alias("fiscal_period"),
        T.blank_to_null(kind).alias("document_type"),
        F.col("extracted.revenue").alias("revenue_reported"),
        F.col("extracted.net_income").alias("net_income_reported"),
    )


def silver(bronze: DataFrame, *, observe_as: str | None = None, expectations=None, **options) -> DataFrame:
    """The silver table: rows with content, ten columns."""
    expectations = Q.SILVER_EXPECTATIONS if expectations is None else expectations
    return Q.apply_expectations(silver_rows(bronze, **options), expectations, observe_as).select(*SILVER_COLUMNS)


def gold(silver_table: DataFrame, category: Callable[[Column], Column] = C.ai_investment_category,
         tone: Callable[[Column], Column] = C.management_sentiment) -> DataFrame:
    """Silver with two labels and without the long text.

    ``category`` and ``tone`` map the text's tokens to a label; the text is
    split once for both.
    """
    words = F.col("_words")
    rows = T.compute_once(silver_table, _words=T.tokens("plain_text"))
    return rows.withColumns(
        {"ai_investment_category": category(words), "management_sentiment": tone(words)}
    ).drop("plain_text", "_words")


def chunks(silver_table: DataFrame, max_chars: int = 1200) -> DataFrame:
    """The search table, from the stored parse (nothing is parsed again)."""
    rows = silver_table.where(F.col("parsed_document").isNotNull())
    return search_table(T.compute_once(rows, elements=P.from_variant("parsed_document")), max_chars=max_chars)


def run_batch(bronze: DataFrame, write: Callable[[DataFrame, str], DataFrame], min_rows: int = 50, **options) -> dict[str, DataFrame]:
    """Build and store every table once; ``write(df, name)`` stores and re-reads.

    Each stage reads the stored one before it, so parsing happens once. The
    gate asks for ``min_rows`` parsed documents.
    """
    out = {"financial_docs_silver": write(silver(bronze, **options), "financial_docs_silver")}
    out["financial_docs_gold"] = write(gold(out["financial_docs_silver"]), "financial_docs_gold")
    out["company_ai_investment_summary"] = write(
        S.investment_summary(out["financial_docs_gold"]), "company_ai_investment_summary"
    )
    out["financial_docs_for_search"] = write(chunks(out["financial_docs_silver"]), "financial_docs_for_search")
    Q.enforce_gate(Q.quality_gate(out["financial_docs_silver"], out["financial_docs_gold"], min_rows=min_rows))
    return out
