"""Documents to structural elements and back to plain text.

Elements are ``array<struct<id, type, content, page_id>>`` inside Spark; the
stored form is a VARIANT shaped ``{"document": {"elements": [...]}}``. Every
step is an expression on one row: parsing never shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions.markup import Elements

ELEMENT = "struct<id:int,type:string,content:string,page_id:int>"
ELEMENTS = f"array<{ELEMENT}>"

PAGE_BREAK = "\f"


def decode_content(content: Column | str) -> Column:
    """Raw bytes as text; malformed bytes become replacement characters."""
    return F.make_valid_utf8(F.col(content).cast("string") if isinstance(content, str) else content.cast("string"))


def _numbered(rows: Column) -> Column:
    return F.transform(
        rows,
        lambda e, i: F.struct(
            i.cast("int").alias("id"),
            e["type"].alias("type"),
            e["content"].alias("content"),
            e["page_id"].alias("page_id"),
        ),
    )


def _row(kind: Column, content: Column, page: Column) -> Column:
    return F.struct(kind.alias("type"), content.alias("content"), page.cast("int").alias("page_id"))


def html_elements(html: Column | str) -> Column:
    """All visible text of a page, in page order: what stands between two block tags is one element.

    The innermost open element names its type: title, section_header, list_item,
    table_cell, preformatted, and text for any other or none. Elements that their page
    leaves open end where a browser ends them; character references are read.
    One pass over each page, an Arrow batch at a time.
    """

    @F.arrow_udf(ELEMENTS)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("id", pa.int32()), ("type", pa.string()), ("content", pa.string()), ("page_id", pa.int32())]))
        for batch in batches:
            found = (None if page is None else Elements(page).found for page in batch.to_pylist())
            yield pa.array([None if rows is None else [(i, *row[:2], 0) for i, row in enumerate(rows)] for rows in found], kind)

    # not marked deterministic: what is built on the elements must not parse again
    return parse.asNondeterministic()(F.col(html) if isinstance(html, str) else html)


def table_cells(df: DataFrame, keys: list[str], col: str = "html") -> DataFrame:
    """One row per table cell of a page: keys, table, row, column, header, content."""
    cell = "struct<table:int,row:int,column:int,header:boolean,content:string>"

    @F.arrow_udf(f"array<{cell}>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("table", pa.int32()), ("row", pa.int32()), ("column", pa.int32()), ("header", pa.bool_()), ("content", pa.string())]))
        for batch in batches:
            yield pa.array([sorted(Elements(page or "").cells) for page in batch.to_pylist()], kind)

    return df.select(*keys, F.explode(parse.asNondeterministic()(col)).alias("c")).select(*keys, "c.*")


def text_elements(text: Column | str, title_first: bool = False) -> Column:
    """One element per non-blank line; form feeds break pages. Line 0 is the title only when asked for."""

    def lines(page: Column, number: Column) -> Column:
        return F.transform(F.filter(F.split(page, "\n"), lambda line: F.trim(line) != ""), lambda line: _row(F.lit("text"), line, number))

    rows = F.flatten(F.transform(F.split(text, PAGE_BREAK), lines))
    if title_first:
        rows = F.transform(rows, lambda e, i: _row(F.when(i == 0, "title").otherwise("text"), e["content"], e["page_id"]))
    return _numbered(rows)


def to_variant(elements: Column) -> Column:
    """The stored form of parsed elements."""
    return F.to_variant_object(F.struct(F.struct(elements.alias("elements")).alias("document")))


def from_variant(parsed: Column | str) -> Column:
    """Elements of a stored document; NULL where the shape does not fit."""
    return F.try_variant_get(parsed, "$.document.elements", ELEMENTS)


def parse_document(df: DataFrame, col: str = "content", fmt: str = "text", title_first: bool = False,
                   into: str = "elements") -> DataFrame:
    """Add parsed elements. ``fmt`` is ``html``, ``text`` or ``auto`` (by markup)."""
    source = decode_content(F.col(col)) if dict(df.dtypes)[col] == "binary" else F.col(col)
    if fmt == "html":
        elements = html_elements(source)
    elif fmt == "text":
        elements = text_elements(source, title_first)
    elif fmt == "auto":
        elements = F.when(source.rlike(r"(?i)^\s*<(?:!doctype html|html)"), html_elements(source)).otherwise(
            text_elements(source, title_first)
        )
    else:
        raise ValueError(f"unknown document format {fmt!r}")
    return T.compute_once(df, **{into: elements})


def plain_text(elements: Column | str) -> Column:
    """Element contents in order, a blank line between; NULL contents are skipped."""
    column = F.col(elements) if isinstance(elements, str) else elements
    return F.concat_ws("\n\n", F.transform(column, lambda e: e["content"]))


def element_rows(df: DataFrame, keys: list[str], elements: str = "elements") -> DataFrame:
    """One row per element."""
    return df.select(*keys, F.explode(elements).alias("e")).select(*keys, "e.id", "e.type", "e.content", "e.page_id")
