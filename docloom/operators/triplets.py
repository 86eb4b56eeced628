"""Text to entity/relationship JSON, and that JSON to typed rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from docloom.functions import text as T
from docloom.functions import vocab as V

ENTITY = "struct<name:string,entity_type:string,description:string>"
RELATION = "struct<subject:string,predicate:string,object:string>"
RESULT = f"struct<data:struct<entities:array<{ENTITY}>,relationships:array<{RELATION}>>>"


def _matches(text: Column, predicate: str, pattern: str, subject_type: str, object_type: str) -> Column:
    """Every hit of one pattern, scanned once, as a struct with both ends."""
    return F.transform(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda hit: F.struct(
            F.regexp_extract(hit, pattern, 1).alias("subject"),
            F.lit(predicate).alias("predicate"),
            F.regexp_extract(hit, pattern, 2).alias("object"),
            F.lit(subject_type).alias("subject_type"),
            F.lit(object_type).alias("object_type"),
            F.trim(hit).alias("description"),
        ),
    )


def stretches_with(stretches: Column, words: str, sign: str) -> Column:
    """A text's stretches between ``sign`` that hold ``words``, with the sign in front of each but the text's first."""
    kept = F.array_join(F.filter(stretches, lambda s: F.contains(s, F.lit(words))), sign)
    return F.when(F.contains(stretches[0], F.lit(words)), kept).otherwise(F.concat(F.lit(sign), kept))


def triplet_json(text: Column | str, patterns=None, words: dict[str, str] | None = None, sign: str = ".") -> Column:
    """``{"data": {"entities": [...], "relationships": [...]}}`` for one text.

    ``patterns`` are ``(predicate, pattern with two groups, subject type, object
    type)``; hits come in pattern order, then text order, repeats included.
    ``words`` names for a predicate what every hit of its pattern holds, where no hit holds
    ``sign`` but as its first character: only stretches with these words are searched.
    """
    patterns = V.TRIPLET_PATTERNS if patterns is None else patterns
    unknown = sorted({p[0] for p in patterns} - set(V.PREDICATES))
    if unknown:
        raise ValueError(f"predicates outside the vocabulary: {unknown}")
    column = F.col(text) if isinstance(text, str) else text

    def hits(stretches: Column) -> Column:
        searched = [stretches_with(stretches, words[p[0]], sign) if words and p[0] in words else column for p in patterns]
        return F.concat(*[_matches(s, *p) for s, p in zip(searched, patterns, strict=True)])

    def result(found: Column) -> Column:
        ends = F.flatten(
            F.transform(
                found,
                lambda h: F.array(
                    F.struct(h["subject"].alias("name"), h["subject_type"].alias("entity_type"), h["description"]),
                    F.struct(h["object"].alias("name"), h["object_type"].alias("entity_type"), h["description"]),
                ),
            )
        )
        # as strings, which array_distinct hashes; structs it compares pair by pair
        entities = F.array_distinct(F.transform(ends, lambda e: F.to_json(e.cast(ENTITY))))
        relations = F.transform(found, lambda h: F.struct(h["subject"], h["predicate"], h["object"]))
        return F.concat(
            F.lit('{"data":{"entities":['),
            F.array_join(entities, ","),
            F.lit('],"relationships":'),
            F.to_json(relations.cast(f"array<{RELATION}>")),
            F.lit("}}"),
        )

    cut = F.split(column, re.escape(sign), -1) if words else F.array(column)
    bound = F.transform(F.array(cut), lambda stretches: F.transform(F.array(hits(stretches)), result)[0])[0]
    return F.when(column.isNotNull(), bound)


def extract_triplets(df: DataFrame, text: str = "plain_text", patterns=None, into: str = "result",
                     words: dict[str, str] | None = None, sign: str = ".") -> DataFrame:
    """Add the extraction JSON. ``materialize`` the result before reading it twice."""
    return df.withColumn(into, triplet_json(text, patterns, words, sign))


def extract_with_model(df: DataFrame, answer: Callable[[list[str]], list[str | None]], prompt: str,
                       text: str = "plain_text", into: str = "result") -> DataFrame:
    """The same column from a user's model: ``answer`` maps prompts to JSON, one Arrow batch at a time.

    Filter and project before calling; nothing is pushed below the model.
    """
    schema = st.StructType(df.schema.fields + [st.StructField(into, st.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asked = [None if value is None else prompt + value for value in batch[text]]
            sent = [a for a in asked if a is not None]
            answers = iter(answer(sent) if sent else [])
            yield batch.assign(**{into: [None if a is None else next(answers) for a in asked]})

    return df.mapInPandas(run, schema)


def parse_structured(df: DataFrame, col: str = "result") -> DataFrame:
    """Add ``parsed`` (typed, NULL where malformed) and the ``malformed`` flag."""
    read = F.col("_read")
    whole = read["data"]["entities"].isNotNull() & read["data"]["relationships"].isNotNull()
    rows = T.compute_once(df, _read=F.from_json(F.col(col), RESULT))
    return rows.withColumns(
        {"parsed": F.when(whole, read), "malformed": F.col(col).isNotNull() & ~F.coalesce(whole, F.lit(False))}
    ).drop("_read")


def entity_mentions(parsed: DataFrame) -> DataFrame:
    """One row per extracted entity."""
    return parsed.select("company", "fiscal_period", F.explode("parsed.data.entities").alias("e")).select(
        "company", "fiscal_period", F.col("e.name").alias("entity_name"), "e.entity_type", "e.description"
    )


def relationship_mentions(parsed: DataFrame) -> DataFrame:
    """One row per extracted relationship."""
    return parsed.select("company", "fiscal_period", F.explode("parsed.data.relationships").alias("r")).select(
        "company", "fiscal_period", "r.subject", "r.predicate", "r.object"
    )
