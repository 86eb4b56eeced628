"""Field extraction, path fallbacks and company names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V


def extract_fields(text: Column | str, labels=None, rules=None) -> Column:
    """A struct with one STRING field per label, NULL where no rule hits.

    ``rules`` maps a label to ``(pattern, group)`` pairs in order of trust.
    """
    rules = V.FIELD_RULES if rules is None else rules
    labels = V.FIELD_LABELS if labels is None else labels

    def first_hit(label: str) -> Column:
        hits = [T.blank_to_null(F.trim(F.regexp_extract(text, pattern, group))) for pattern, group in rules.get(label, [])]
        return F.coalesce(*hits, F.lit(None).cast("string")).alias(label)

    return F.struct(*[first_hit(label) for label in labels])


def document_type_or_folder(extracted: Column, path: Column | str, root: str = V.RAW_ROOT) -> Column:
    """The extracted type, else the first folder under ``root`` (empty text if none)."""
    return F.coalesce(extracted, T.folder_after(path, root))


def company_or_file_prefix(extracted: Column, path: Column | str) -> Column:
    """The extracted company, else the file name's first part."""
    return F.coalesce(extracted, T.name_prefix(path))


def fallback_columns(df: DataFrame, path: str = "source_path", document_type: str = "extracted_document_type",
                     company: str = "extracted_company") -> DataFrame:
    return df.withColumn("document_type", document_type_or_folder(F.col(document_type), path)).withColumn(
        "company", company_or_file_prefix(F.col(company), path)
    )


def _company_words(name: Column | str) -> Column:
    """Tokens of a company name without legal suffixes."""
    return F.filter(T.tokens(name), lambda t: ~t.isin(V.COMPANY_SUFFIXES))


def _alias_words(alias: str) -> str:
    words = re.split(r"[\W_]+", alias.lower())
    return " ".join(w for w in words if w and w not in V.COMPANY_SUFFIXES)


def canonicalize(name: Column | str, aliases: dict[str, str] | None = None) -> Column:
    """Canonical name of a spelling or ticker, else NULL.

    The spelling loses punctuation and legal suffixes, then matches the longest
    alias that equals it or its leading words.
    """
    aliases = V.COMPANY_ALIASES if aliases is None else aliases
    known = {_alias_words(alias): target for alias, target in aliases.items()}
    spelled = F.concat(F.array_join(_company_words(name), " "), F.lit(" "))
    longest_first = sorted(known, key=lambda words: (-len(words), words))
    hits = [F.when(spelled.startswith(words + " "), F.lit(known[words])) for words in longest_first]
    return F.coalesce(*hits, F.lit(None).cast("string"))


def canonicalize_by_table(df: DataFrame, name: str, aliases: DataFrame, into: str = "canonical") -> DataFrame:
    """The same answer for an alias *table* ``(alias, canonical)`` of any size.

    Each distinct spelling offers its leading word groups, and an equi-join
    finds the longest alias among them; nothing is broadcast by hint.
    """
    spellings = df.select(F.col(name).alias("_name")).where(F.col(name).isNotNull()).distinct()
    openings = spellings.select("_name", _company_words("_name").alias("_words")).where(F.size("_words") > 0).select(
        "_name",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("_words")),
                        lambda n: F.array_join(F.slice("_words", 1, n), " "))
        ).alias("_form"),
    )
    forms = (
        aliases.select(F.array_join(_company_words("alias"), " ").alias("_form"), F.col("canonical").alias("_target"))
        .groupBy("_form")
        .agg(F.min("_target").alias("_target"))
    )
    best = openings.join(forms, "_form").groupBy("_name").agg(F.max_by("_target", F.length("_form")).alias(into))
    return df.join(best, df[name] == best["_name"], "left").drop("_name")
