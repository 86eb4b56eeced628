"""Structural chunks with an enriched twin text for embedding."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.quality import pk_duplicates

CHUNK = "struct<section:int,part:bigint,header:string,page_id:int,text:string>"

SEARCH_COLUMNS = ["chunk_id", "chunk_to_embed", "chunk_text", "source_path", "company", "fiscal_period", "document_type"]


def chunk_array(elements: Column, max_chars: int = 1200) -> Column:
    """Chunks of one document's elements, in order.

    A section header starts a section; inside a section an element belongs to
    part ``floor(characters before it / max_chars)``. One pass over the row's
    elements, an Arrow batch at a time: a document is chunked where it lies,
    without a shuffle, and a chunk's text is joined once.
    """

    @F.arrow_udf(f"array<{CHUNK}>")
    def chunk(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("section", pa.int32()), ("part", pa.int64()), ("header", pa.string()), ("page_id", pa.int32()), ("text", pa.string())]))
        for headers, contents, pages in batches:
            rows = zip(headers.to_pylist(), contents.to_pylist(), pages.to_pylist(), strict=True)
            yield pa.array([None if texts is None else _chunks(is_header, texts, page, max_chars) for is_header, texts, page in rows], kind)

    readable = F.filter(elements, lambda e: e["content"].isNotNull())
    columns = (
        F.transform(readable, lambda e: F.coalesce(e["type"] == "section_header", F.lit(False))),
        F.transform(readable, lambda e: e["content"]),
        F.transform(readable, lambda e: e["page_id"]),
    )
    # not marked deterministic: what is built on the chunks must not chunk again
    return chunk.asNondeterministic()(*columns)


def _chunks(is_header: list[bool], texts: list[str], pages: list[int | None], max_chars: int) -> list[dict]:
    """Chunks of one document as rows of CHUNK."""
    done: list[dict] = []
    section, header, before, opened = 0, None, 0, None
    for starts, text, page in zip(is_header, texts, pages, strict=True):
        if starts:
            section, header, before = section + 1, text, 0
        key = (section, before // max_chars)
        if key != opened:
            opened = key
            done.append({"section": key[0], "part": key[1], "header": header, "page_id": page, "text": []})
        done[-1]["text"].append(text)
        before += len(text)
    for row in done:
        row["text"] = "\n\n".join(row["text"])
    return done


def chunk_documents(df: DataFrame, key: str = "source_path", elements: str = "elements", max_chars: int = 1200,
                    carry: list[str] | None = None) -> DataFrame:
    """One row per chunk; documents without elements give none.

    ``chunk_id`` is ``<key>_chunk<position>``; ``chunk_to_embed`` puts title,
    section header and page number in front of the text.
    """
    carry = [c for c in (SEARCH_COLUMNS[3:] if carry is None else carry) if c in df.columns]
    title = F.get(F.filter(F.col(elements), lambda e: e["type"] == "title"), F.lit(0))["content"]
    cut = df.select(
        *dict.fromkeys([key, *carry]), title.alias("_title"), chunk_array(F.col(elements), max_chars).alias("_chunks")
    )
    chunks = cut.select("*", F.posexplode("_chunks").alias("_pos", "_chunk"))
    return chunks.select(
        F.concat(F.col(key).cast("string"), F.lit("_chunk"), F.col("_pos").cast("string")).alias("chunk_id"),
        F.concat_ws(
            "\n",
            "_title",
            "_chunk.header",
            F.concat(F.lit("Page "), F.col("_chunk.page_id").cast("string")),
            "_chunk.text",
        ).alias("chunk_to_embed"),
        F.col("_chunk.text").alias("chunk_text"),
        *carry,
    )


def search_table(silver: DataFrame, elements: str = "elements", max_chars: int = 1200) -> DataFrame:
    """The seven-column search table: parsed documents only, one row per chunk."""
    return chunk_documents(silver, "source_path", elements, max_chars).select(*SEARCH_COLUMNS)


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Number of chunks and of distinct documents behind them."""
    return chunks.groupBy("source_path").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("chunk_count"), F.count("source_path").alias("document_count")
    )


def duplicate_chunks(chunks: DataFrame) -> DataFrame:
    return pk_duplicates(chunks, "chunk_id")
