"""Context for a table of questions from retrieval, graph and metadata.

Everything is a join over ``(query_id, question, companies)`` rows, so one plan
serves any number of questions. Per question the text is bounded: ``max_chunks``
excerpts, ``GRAPH_LINES`` relations, and the categories of its companies.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import vocab as V
from docloom.operators.graph import TRIPLE, _first_n
from docloom.operators.retrieve import chunks_of, hybrid_topk
from docloom.session import materialize

if TYPE_CHECKING:
    from docloom.operators.postings import StoredIndex

# --- fixed values: section headings and limits of the assembled text --------
HEADINGS = [
    "## 📃 Relevant Document Excerpts (from Vector Search) 📃",
    "\n\n## 🏭 Key Entity Relationships (from Knowledge Graph) 🏭",
    "\n\n## 💰 AI Investment Signals (from Metadata Layer) 💰",
]
CONTEXT_PREDICATES = ["partners_with", "invests_in", "uses_technology"]
GRAPH_LINES = 20
PART_CHARS = 1000
# ---------------------------------------------------------------------------

PROMPT = (
    "Answer the question from the context alone. Name the companies you rely on "
    "and point out what they have in common.\n\n<context>\n%s\n</context>\n\nQuestion: %s\n"
)


def _wide(text: Column | str, width: int) -> Column:
    """Blank-padded to ``width``; longer text stays whole."""
    column = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.rpad(column, F.greatest(F.length(column), F.lit(width)), F.lit(" "))


def graph_line(subject, predicate, obj, mentions) -> Column:
    return F.concat(
        _wide(subject, 30), F.lit(" → "), _wide(predicate, 20), F.lit(" → "), _wide(obj, 30),
        F.lit(" ("), F.col(mentions).cast("string"), F.lit(" mentions)"),
    )


def signal_line(company, category, total) -> Column:
    return F.concat(
        _wide(company, 30), F.lit(": "), _wide(category, 30), F.lit(" — "), F.col(total).cast("string"), F.lit(" documents")
    )


def format_lines(relations: DataFrame, signals: DataFrame) -> DataFrame:
    """Both kinds of fixed-width lines as ``(layer, line)``."""
    graph = relations.select(F.lit("graph").alias("layer"), graph_line(*TRIPLE, "mentions").alias("line"))
    meta = signals.select(
        F.lit("signals").alias("layer"), signal_line("company", "ai_investment_category", "total_docs").alias("line")
    )
    return graph.unionByName(meta)


def single_company(companies: Column | str) -> Column:
    """The company to filter retrieval by: only when exactly one was asked for."""
    return F.when(F.size(companies) == 1, F.get(companies, F.lit(0)))


def context_targets(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """``(query_id, company)``: those asked for, else those retrieved, else all five.

    ``retrieved`` rows are ``(query_id, company)``, at most one per excerpt.
    """
    seen = (
        retrieved.where(F.col("company").isNotNull()).groupBy("query_id")
        .agg(F.array_sort(F.collect_set("company")).alias("_seen"))
    )
    asked = F.when(F.size("companies") > 0, F.col("companies"))
    every = F.array(*[F.lit(c) for c in V.COMPANIES])
    return questions.join(seen, "query_id", "left").select(
        "query_id", F.explode(F.coalesce(asked, F.col("_seen"), every)).alias("company")
    ).distinct()


def company_relations(targets: DataFrame, relationships: DataFrame, predicates: list[str] | None = None,
                      aliases: dict[str, str] | None = None, limit: int | None = GRAPH_LINES) -> DataFrame:
    """Each query's relations of its companies, by subject and mentions.

    Subjects are matched by canonical name. A subject's relations are cut to
    ``limit`` before the join; the per-query cut cannot need more of them.
    """
    from docloom.operators.extract import canonicalize

    wanted = relationships.where(F.col("predicate").isin(CONTEXT_PREDICATES if predicates is None else predicates))
    canonical = F.coalesce(canonicalize("subject", aliases), F.col("subject"))
    totals = wanted.groupBy(*TRIPLE).agg(F.sum("mention_count").alias("mentions")).withColumn("company", canonical)
    order = ["subject", F.desc("mentions"), "predicate", "object"]
    if limit is not None:
        totals = _first_n(totals, ["company"], order, limit)
    found = targets.join(totals, "company").select("query_id", *TRIPLE, "mentions")
    return found if limit is None else _first_n(found, ["query_id"], order, limit)


def company_signals(targets: DataFrame, summary: DataFrame) -> DataFrame:
    """Each query's AI-related document totals per company and category."""
    totals = summary.where(F.col("ai_investment_category") != V.NOT_AI).groupBy("company", "ai_investment_category").agg(
        F.sum("document_count").alias("total_docs")
    )
    return targets.join(totals, "company").select("query_id", "company", "ai_investment_category", "total_docs")


def _part(section: int, order: Column, text: Column) -> list[Column]:
    return ["query_id", F.lit(section).alias("section"), order.cast("int").alias("ord"), text.alias("text")]


def context_parts(questions: DataFrame, excerpts: DataFrame, relations: DataFrame, signals: DataFrame) -> DataFrame:
    """``(query_id, section, ord, text)`` in reading order; each section opens with its heading.

    ``excerpts`` rows are ``(query_id, rank, company, fiscal_period, document_type, chunk_text)``.
    """
    shown = [F.coalesce(F.col(c), F.lit("None")) for c in ("company", "fiscal_period", "document_type")]
    excerpt = F.array(
        F.concat(F.lit("⬇️ ["), shown[0], F.lit(" | "), shown[1], F.lit(" | "), shown[2], F.lit("] ⬇️")),
        F.col("chunk_text"),
        F.lit("⬆️  ⬆️\n"),
    )
    parts = questions.select(
        "query_id", F.posexplode(F.array(*[F.lit(h) for h in HEADINGS])).alias("section", "text")
    ).select("query_id", "section", F.lit(0).alias("ord"), "text")
    cut = excerpts.select("query_id", "rank", F.posexplode(excerpt).alias("_piece", "_text"))
    parts = parts.unionByName(cut.select(*_part(0, (F.col("rank") - 1) * 3 + F.col("_piece") + 1, F.col("_text"))))
    by_subject = Window.partitionBy("query_id").orderBy("subject", F.desc("mentions"), "predicate", "object")
    lines = relations.select("query_id", F.row_number().over(by_subject).alias("_n"), graph_line(*TRIPLE, "mentions").alias("_text"))
    parts = parts.unionByName(lines.select(*_part(1, F.col("_n"), F.col("_text"))))
    by_company = Window.partitionBy("query_id").orderBy("company", F.desc("total_docs"), "ai_investment_category")
    totals = signals.select(
        "query_id", F.row_number().over(by_company).alias("_n"),
        signal_line("company", "ai_investment_category", "total_docs").alias("_text"),
    )
    return parts.unionByName(totals.select(*_part(2, F.col("_n"), F.col("_text"))))


def hybrid_context(questions: DataFrame, index: DataFrame | StoredIndex, relationships: DataFrame, summary: DataFrame,
                   max_chunks: int = 10, aliases: dict[str, str] | None = None, item_id: str = "chunk_id") -> DataFrame:
    """All three layers for each row of ``questions`` (``query_id, question, vector, companies``)."""
    asked = questions.withColumn("_only", single_company("companies"))
    chunks = chunks_of(index)
    ranking = hybrid_topk(asked, index, max_chunks, item_id=item_id, query_only="_only", item_only="company",
                          item_tokens="tokens" if "tokens" in chunks.columns else None)
    # stored: both the excerpts and the companies to look up read it
    excerpts = materialize(ranking, "ranking").join(
        chunks.select(F.col(item_id).alias("item_id"), "company", "fiscal_period", "document_type", "chunk_text"), "item_id"
    ).select("query_id", "rank", "company", "fiscal_period", "document_type", "chunk_text")
    targets = context_targets(questions, excerpts.select("query_id", "company"))
    relations = company_relations(targets, relationships, aliases=aliases)
    return context_parts(questions, excerpts, relations, company_signals(targets, summary))


def assemble_context(parts: DataFrame, part_chars: int = PART_CHARS) -> DataFrame:
    """One string per query: every part cut to ``part_chars``, in order, joined without a gap."""
    piece = F.struct("section", "ord", F.substring("text", 1, part_chars).alias("text"))
    ordered = F.array_sort(F.collect_list(piece))
    return parts.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("context")
    )


def build_prompt(contexts: DataFrame, questions: DataFrame, template: str = PROMPT) -> DataFrame:
    """Context and question in the template (two ``%s`` places)."""
    return contexts.join(questions.select("query_id", "question"), "query_id").select(
        "query_id", F.format_string(template, "context", "question").alias("prompt")
    )
