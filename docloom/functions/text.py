"""Tokens, path parts and identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column | str) -> Column:
    """Lower-cased letter/digit runs of ``text``, in order."""
    return F.array_remove(F.split(F.lower(text), TOKEN_BREAK), "")


def token_key(text: Column | str) -> Column:
    """Tokens joined by one blank: the spelling-insensitive form of a name."""
    return F.array_join(tokens(text), " ")


def count_of(token_array: Column, words) -> Column:
    """How many entries of ``token_array`` are in ``words`` (with repeats)."""
    chosen = sorted(set(words))
    if not chosen:
        return F.lit(0)
    return F.size(F.filter(token_array, lambda t: t.isin(chosen)))


def pad_number(number: Column, width: int = 3) -> Column:
    """Zero-pad to at least ``width`` digits; longer numbers stay whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_after(path: Column | str, root: str) -> Column:
    """First folder below ``root``; empty text where the path is not under it."""
    return F.regexp_extract(path, rf"{root}/([^/]+)", 1)


def name_prefix(path: Column | str) -> Column:
    """File name up to its first underscore or dot."""
    return F.regexp_extract(file_name(path), r"^([^_.]+)", 1)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def sanitize_identifier(login: Column | str) -> Column:
    """Part before ``@`` as a schema-safe name."""
    local = F.lower(F.regexp_replace(login, "@.*$", ""))
    return F.regexp_replace(F.regexp_replace(local, "[^a-z0-9]", "_"), "^_+|_+$", "")


def duration_text(seconds: Column) -> Column:
    """``Xm Ys``; a dash for an unknown or zero duration."""
    whole = F.floor(seconds).cast("bigint")
    return F.when(
        seconds != 0,
        F.format_string("%dm %ds", F.floor(whole / 60).cast("bigint"), whole % 60),
    ).otherwise(F.lit("—"))


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters read but do not re-evaluate.

    A filter on a projected column is pushed below the projection with a copy
    of its expression; a generator's output is not, so the costly expression
    runs once per row.
    """
    added = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(added)))
