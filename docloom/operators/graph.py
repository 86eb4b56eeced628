"""Knowledge graph: entities, relationships and questions answered by joins.

Names can be hubs. Joins therefore meet tables that are unique on their key or
cut to the rows a top-n answer can use, and hub-side rows are aggregated before
they are shuffled on the hub's name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.session import materialize

ENTITY_COLUMNS = ["company", "fiscal_period", "entity_name", "entity_type", "description", "UID"]
TRIPLE = ["subject", "predicate", "object"]


# ------------------------------------------------------------ building it ----
def dedupe_entities(mentions: DataFrame) -> DataFrame:
    """One row per (name, type): the smallest (company, period, description) survives."""
    return (
        mentions.groupBy("entity_name", "entity_type")
        .agg(F.min(F.struct("company", "fiscal_period", "description")).alias("kept"))
        .select("kept.company", "kept.fiscal_period", "entity_name", "entity_type", "kept.description")
    )


def counted_mentions(mentions: DataFrame) -> DataFrame:
    """Mentions with ``_n``: equal ones of an Arrow batch are one row.

    A triple that comes often is cut down before it is shuffled, in bounded memory and without a sort:
    a partial aggregate would sort all rows of a task first, and most triples come once.
    """
    names = [*TRIPLE, "company", "fiscal_period"]
    rows = mentions.select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.Table.from_batches([batch]).group_by(names, use_threads=False).aggregate([([], "count_all")])
                yield from found.select([*names, "count_all"]).rename_columns([*names, "_n"]).to_batches()

    return rows.mapInArrow(run, mentions.select(*names).schema.add("_n", "long"))


def dedupe_relationships(mentions: DataFrame) -> DataFrame:
    """One row per (subject, predicate, object) with the number of mentions.

    Rows are sorted once, where their triple's other mentions are.
    """
    return (
        counted_mentions(mentions).repartition(*TRIPLE).groupBy(*TRIPLE)
        .agg(F.min(F.struct("company", "fiscal_period")).alias("kept"), F.coalesce(F.sum("_n"), F.lit(0)).alias("mention_count"))
        .select("kept.company", "kept.fiscal_period", *TRIPLE, "mention_count")
    )


def uid_text(kind: Column, number: Column) -> Column:
    return F.concat(kind, F.lit("_"), T.pad_number(number))


def assign_uid(entities: DataFrame) -> DataFrame:
    """``<type>_<nnn>``: the row's number within its type, by name.

    Types are few, so a window per type would number millions of names in a
    handful of tasks. Instead rows are range-sorted by (type, name) and stored,
    each keeping its task's running id; a small aggregate per (task, type)
    gives the offset to add. Equal to ``row_number()`` for distinct names.
    """
    ordered = entities.repartitionByRange("entity_type", "entity_name").sortWithinPartitions("entity_type", "entity_name")
    ordered = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "entity-order")
    # the upper bits of the id name the task that sorted the row
    ordered = ordered.withColumn("_task", F.shiftright("_at", 33))
    runs = ordered.groupBy("_task", "entity_type").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("entity_type").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    numbered = ordered.join(
        runs.withColumnRenamed("entity_type", "_type"),
        (F.col("entity_type").eqNullSafe(F.col("_type"))) & (ordered["_task"] == runs["_task"]),
    )
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return numbered.withColumn("UID", uid_text(F.col("entity_type"), number)).select(*ENTITY_COLUMNS)


def assign_uid_windowed(entities: DataFrame) -> DataFrame:
    """The plain window form; the definition that ``assign_uid`` must equal."""
    order = Window.partitionBy("entity_type").orderBy("entity_name")
    return entities.withColumn("UID", uid_text(F.col("entity_type"), F.row_number().over(order))).select(*ENTITY_COLUMNS)


def build_entities(mentions: DataFrame) -> DataFrame:
    return assign_uid(dedupe_entities(mentions))


def build_relationships(mentions: DataFrame) -> DataFrame:
    return dedupe_relationships(mentions)


def shuffled(names: DataFrame) -> DataFrame:
    """The side of a join that has a row for each name, never broadcast.

    The planner goes by the size of stored files, where names take a fiftieth or less of what they take in
    memory: millions of them would be gathered in the driver.
    """
    return names.hint("merge")


def missing_entities(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """Distinct names at either end of a relationship that have no entity row."""
    ends = relationships.select(F.explode(F.array("subject", "object")).alias("entity_name"))
    return ends.where(F.col("entity_name").isNotNull()).distinct().join(
        shuffled(entities.select("entity_name")), "entity_name", "left_anti"
    )


def backfill_entities(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """The missing names as ``Unknown`` entities, numbered like the others."""
    rows = missing_entities(relationships, entities).select(
        F.lit(V.UNKNOWN).alias("company"),
        F.lit(V.UNKNOWN).alias("fiscal_period"),
        "entity_name",
        F.lit(V.UNKNOWN).alias("entity_type"),
        F.lit(V.BACKFILL_DESCRIPTION).alias("description"),
    )
    return assign_uid(rows)


def entities_with_backfill(entities: DataFrame, relationships: DataFrame) -> DataFrame:
    return entities.select(*ENTITY_COLUMNS).unionByName(backfill_entities(relationships, entities))


def node_table(entities: DataFrame) -> DataFrame:
    """One row per name: a known type before ``Unknown``, then the first type."""
    unknown_last = (F.col("entity_type") == V.UNKNOWN).cast("int")
    return (
        entities.groupBy("entity_name")
        .agg(F.min(F.struct(unknown_last.alias("late"), "entity_type", "UID")).alias("node"))
        .select("entity_name", "node.entity_type", "node.UID")
    )


def edge_table(relationships: DataFrame, entities: DataFrame) -> DataFrame:
    """Adjacency rows with node ids, types and JSON labels on both sides.

    Node rows are unique per name, so both left joins keep the row count.
    """
    nodes = node_table(entities)

    def side(prefix: str, end: str) -> DataFrame:
        return shuffled(nodes.select(
            F.col("entity_name").alias(end),
            F.col("UID").alias(f"{prefix}_id"),
            F.col("entity_type").alias(f"{prefix}_type"),
        ))

    joined = relationships.join(side("node_start", "subject"), "subject", "left").join(
        side("node_end", "object"), "object", "left"
    )

    def label(end: str) -> Column:
        return F.when(F.col(end).isNotNull(), F.to_json(F.struct(F.col(end).alias("_label"))))

    return joined.select(
        "node_start_id",
        F.coalesce("node_start_type", F.lit("entity")).alias("node_start_key"),
        "subject",
        F.col("predicate").alias("relationship"),
        "object",
        "node_end_id",
        F.coalesce("node_end_type", F.lit("entity")).alias("node_end_key"),
        label("subject").alias("node_start_properties"),
        label("object").alias("node_end_properties"),
        F.parse_json(F.lit("{}")).alias("edge_properties"),
    )


# --------------------------------------------------------------- asking it ----
def entity_type_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("entity_type").agg(F.count(F.lit(1)).alias("entities")).orderBy(F.desc("entities"), "entity_type")


def predicate_counts(relationships: DataFrame) -> DataFrame:
    return relationships.groupBy("predicate").agg(F.count(F.lit(1)).alias("relationships")).orderBy(
        F.desc("relationships"), "predicate"
    )


def relations_of_subject(relationships: DataFrame, subject_pattern: str, predicate: str) -> DataFrame:
    """Relations whose subject matches a case-insensitive pattern, latest period first."""
    return relationships.where(F.col("subject").ilike(subject_pattern) & F.col("predicate").ilike(predicate)).select(
        *TRIPLE, "fiscal_period"
    ).orderBy(F.desc("fiscal_period"), *TRIPLE)


def pair_relations(relationships: DataFrame, a_pattern: str, b_name: str) -> DataFrame:
    """How two entities are related, in either direction, with where it was said."""
    def between(one: str, other: str) -> Column:
        return F.col(one).ilike(a_pattern) & (F.col(other) == b_name)

    return (
        relationships.where(between("subject", "object") | between("object", "subject"))
        .select(*TRIPLE, F.col("company").alias("mentioned_in"), "fiscal_period")
        .distinct()
        .orderBy("fiscal_period", *TRIPLE, "mentioned_in")
    )


def _first_n(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= n).drop("_n")


def two_hop(relationships: DataFrame, origin_pattern: str, first: str, then: list[str], limit: int | None = 20) -> DataFrame:
    """Paths origin -first-> partner -then-> target that do not return to the origin.

    With a limit, each side keeps at most ``limit`` rows per partner before the
    join: paths are ordered by partner, then hop two, then hop one, so no other
    row can be among the first ``limit``. A hub never multiplies out.
    """
    one = relationships.where(F.col("subject").ilike(origin_pattern) & (F.col("predicate") == first)).select(
        F.col("object").alias("partner"), F.col("subject").alias("company"), F.col("predicate").alias("hop1_rel")
    ).distinct()
    two = relationships.where(F.col("predicate").isin(then) & ~F.col("object").ilike(origin_pattern)).select(
        F.col("subject").alias("partner"), F.col("predicate").alias("hop2_rel"), F.col("object").alias("partners_partner")
    ).distinct()
    if limit is not None:
        one = _first_n(one, ["partner"], ["company", "hop1_rel"], limit)
        two = _first_n(two, ["partner"], ["partners_partner", "hop2_rel"], limit)
    paths = one.join(two, "partner").select("company", "hop1_rel", "partner", "hop2_rel", "partners_partner")
    if limit is None:
        return paths
    return paths.orderBy("partner", "partners_partner", "hop2_rel", "company", "hop1_rel").limit(limit)


def shared_targets(relationships: DataFrame, predicates: list[str], min_subjects: int = 3, limit: int = 20) -> DataFrame:
    """Objects that at least ``min_subjects`` distinct subjects point at, most shared first."""
    return (
        relationships.where(F.col("predicate").isin(predicates))
        .select("object", "subject").distinct()
        .groupBy("object").agg(F.count("subject").alias("mentioned_by_n_companies"))
        .where(F.col("mentioned_by_n_companies") >= min_subjects)
        .select(F.col("object").alias("ai_entity"), "mentioned_by_n_companies")
        .orderBy(F.desc("mentioned_by_n_companies"), "ai_entity")
        .limit(limit)
    )


def shared_target_members(relationships: DataFrame, predicates: list[str], min_subjects: int = 3,
                          limit: int = 20) -> DataFrame:
    """``shared_targets`` with its subjects, one row each: a hub's set can be any size."""
    members = relationships.where(F.col("predicate").isin(predicates) & F.col("subject").isNotNull()).select(
        F.col("object").alias("ai_entity"), F.col("subject").alias("mentioned_by")
    ).distinct()
    return shared_targets(relationships, predicates, min_subjects, limit).join(members, "ai_entity").select(
        "ai_entity", "mentioned_by_n_companies", "mentioned_by"
    )


def title_join(entities: DataFrame, relationships: DataFrame, title: str = "chief") -> DataFrame:
    """What persons whose description names ``title`` say, relation by relation."""
    people = entities.where(
        (F.col("entity_type") == "Person") & F.contains(F.lower("description"), F.lit(title.lower()))
    ).select(F.col("entity_name").alias("subject"), F.col("description").alias("title"))
    return relationships.join(people, "subject").select(
        F.col("subject").alias("chief_person"), "title", "predicate", F.col("object").alias("mentioned_entity")
    )


def object_frequency(relationships: DataFrame, subject_pattern: str, predicate: str = "supplies_to") -> DataFrame:
    """How often matching subjects relate to each object (case-sensitive pattern)."""
    return (
        relationships.where(
            F.col("subject").like(subject_pattern) & (F.col("predicate") == predicate) & F.col("object").isNotNull()
        )
        .groupBy("object").agg(F.sum("mention_count").alias("supply_count"))
        .orderBy(F.desc("supply_count"), "object")
    )


def partnership_mentions(relationships: DataFrame, subjects: list[str], predicates: list[str], limit: int = 20) -> DataFrame:
    """Mentions per triple for given subjects, most mentioned first within a subject."""
    return (
        relationships.where(F.col("subject").isin(subjects) & F.col("predicate").isin(predicates))
        .groupBy(F.col("subject").alias("company"), "predicate", F.col("object").alias("partner"))
        .agg(F.sum("mention_count").alias("mention_count"))
        .orderBy("company", F.desc("mention_count"), "predicate", "partner")
        .limit(limit)
    )


def top_objects_by_predicate(relationships: DataFrame, predicate: str | None = None, subject_pattern: str | None = None,
                             limit: int = 20) -> DataFrame:
    """Objects most mentioned under optional predicate and subject conditions."""
    rows = relationships.where(F.col("object").isNotNull())
    if predicate is not None:
        rows = rows.where(F.col("predicate") == predicate)
    if subject_pattern is not None:
        rows = rows.where(F.col("subject").ilike(subject_pattern))
    return (
        rows.groupBy("object").agg(F.sum("mention_count").alias("mentions"))
        .orderBy(F.desc("mentions"), "object").limit(limit)
    )


def entity_lookup(relationships: DataFrame, entity: str, predicate: str | None = None, limit: int = 20) -> DataFrame:
    """Relations with the entity at either end, optionally of one predicate."""
    rows = relationships.where((F.col("subject") == entity) | (F.col("object") == entity))
    if predicate is not None:
        rows = rows.where(F.col("predicate") == predicate)
    return rows.select(*TRIPLE).orderBy("predicate", "subject", "object").limit(limit)


def entity_lookup_batch(relationships: DataFrame, names: DataFrame, predicate: str | None = None, limit: int = 20) -> DataFrame:
    """``entity_lookup`` for a table of entity names, ``limit`` rows each.

    Either end is an equi-join of its own, and each end offers at most ``limit``
    rows per entity, which is all an entity's answer can use.
    """
    rows = relationships if predicate is None else relationships.where(F.col("predicate") == predicate)
    rows = rows.select(*TRIPLE)
    asked = shuffled(names.select("entity_name").distinct())

    def end(name: str) -> DataFrame:
        # an entity's first rows don't depend on who asks, so they are found before the shuffle
        first = _first_n(rows.withColumn("entity_name", F.col(name)), ["entity_name"], ["predicate", "subject", "object"], limit)
        return first.join(asked, "entity_name", "left_semi")

    both = end("subject").unionByName(end("object").where(~F.col("subject").eqNullSafe(F.col("object"))))
    return _first_n(both, ["entity_name"], ["predicate", "subject", "object"], limit).select("entity_name", *TRIPLE)


def pattern_match(relationships: DataFrame, entities: DataFrame, start_type: str, predicate: str, end_type: str) -> DataFrame:
    """``(a:start_type)-[:predicate]->(b:end_type)`` with both node ids."""
    nodes = node_table(entities)
    a = nodes.where(F.col("entity_type") == start_type).select(F.col("entity_name").alias("subject"), F.col("UID").alias("start_id"))
    b = nodes.where(F.col("entity_type") == end_type).select(F.col("entity_name").alias("object"), F.col("UID").alias("end_id"))
    edges = relationships.where(F.col("predicate") == predicate).select("subject", "object").distinct()
    return edges.join(a, "subject").join(b, "object").select("start_id", "subject", "end_id", "object")


#: Bytes of names that tasks are sent at once.
NAME_BYTES = 64 << 20


class Mentions:
    """An Aho-Corasick automaton over words: every known name in a text, in one pass, however long names are.

    A name is found wherever its words follow each other, also inside or across another name.
    """

    def __init__(self, names: list[str]) -> None:
        import ahocorasick

        self.numbers: dict[str, int] = {}
        self.names, self.automaton = names, ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, name in enumerate(names):
            self.automaton.add_word(tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in name.split(" ")), k)
        if names:
            self.automaton.make_automaton()

    def found(self, words: list[str] | None) -> list[str]:
        """Distinct names, in their own order; a word of no name ends what was begun."""
        if not words or not self.names:
            return []
        numbers = tuple(map(self.numbers.get, words, repeat(0)))
        return [self.names[k] for k in sorted({k for _, k in self.automaton.iter(numbers)})]


def mentions(texts: DataFrame, names: DataFrame, words: str = "_words", name: str = "_name") -> DataFrame:
    """``texts`` without ``words``, a row for each distinct name that the words hold.

    Names are dealt by their first word into as many parts as keep each within
    ``NAME_BYTES``; a part's automaton is built once a task and reads each text once.
    """
    names = materialize(names.where(F.col(name) != "").select(name).distinct(), "names")
    size = names.agg(F.coalesce(F.sum(F.octet_length(name) + 16), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / NAME_BYTES))
    first = F.pmod(F.xxhash64(F.substring_index(name, " ", 1)), F.lit(parts))
    kept = [c for c in texts.columns if c != words]
    schema = texts.select(*kept).schema.add(name, "string")

    def read(part: DataFrame) -> DataFrame:
        sent = texts.sparkSession.sparkContext.broadcast(sorted(part.toArrow().column(name).to_pylist()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                known = known or Mentions(sent.value)  # a task without texts builds none
                found = [known.found(w) for w in batch.column(words).to_pylist()]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                columns = [batch.column(c).take(pa.array(row)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([n for f in found for n in f], pa.string())], names=schema.names)

        return texts.select(*kept, words).mapInArrow(run, schema)

    return reduce(DataFrame.unionByName, [read(names.where(first == k) if parts > 1 else names) for k in range(parts)])


def entity_link(ranking: DataFrame, corpus: DataFrame, relationships: DataFrame, *, item_id: str = "chunk_id",
                text: str = "chunk_text", predicates: list[str] | None = None, per_entity: int | None = None) -> DataFrame:
    """Relations of the entities that a query's retrieved items mention.

    Subject names are found in the retrieved texts by one automaton. Each subject
    offers all its relations, or its ``per_entity`` most mentioned.
    """
    known = relationships if predicates is None else relationships.where(F.col("predicate").isin(predicates))
    totals = known.groupBy(*TRIPLE).agg(F.sum("mention_count").alias("mentions"))
    best = totals if per_entity is None else _first_n(totals, ["subject"], [F.desc("mentions"), "predicate", "object"], per_entity)
    best = best.withColumn("_name", T.token_key("subject"))
    words = F.col("tokens") if "tokens" in corpus.columns else T.tokens(text)
    retrieved = materialize(ranking.select("query_id", "item_id"), "ranking").join(
        corpus.select(F.col(item_id).alias("item_id"), words.alias("_words")), "item_id"
    )
    # as many tasks as there are slots, not as the corpus has splits: each builds the automaton
    slots = ranking.sparkSession.sparkContext.defaultParallelism
    texts = materialize(retrieved.select("query_id", "_words"), "retrieved").repartition(slots)
    mentioned = mentions(texts, known.select(T.token_key("subject").alias("_name"))).distinct()
    # the answer is far longer than what is joined, and one name can have most of it: names are dealt by their triples too
    part, parts = F.pmod(F.xxhash64(*TRIPLE), F.lit(slots)).cast("int"), F.sequence(F.lit(0), F.lit(slots - 1))
    dealt = best.withColumn("_part", part).repartition(slots, "_name", "_part")
    asked = mentioned.withColumn("_part", F.explode(parts)).repartition(slots, "_name", "_part")
    return asked.join(dealt, ["_name", "_part"]).select("query_id", *TRIPLE, "mentions")


# ------------------------------------------------------ the stored graph ----
def write_graph(relationships: DataFrame, name: str, buckets: int = 64) -> None:
    """Store triples twice, as tables ``name_by_subject`` and ``name_by_object``: bucketed and sorted by that end, with bloom filters on it."""
    for end in ("subject", "object"):
        (relationships.repartition(buckets, end).write.mode("overwrite").format("parquet")
         .option(f"parquet.bloom.filter.enabled#{end}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
         .bucketBy(buckets, end).sortBy(end).saveAsTable(f"{name}_by_{end}"))


def drop_graph(spark: SparkSession, name: str) -> None:
    """Drop both tables of a stored graph."""
    for end in ("subject", "object"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_by_{end}")


def stored_two_hop(spark: SparkSession, name: str, origin_pattern: str, first: str, then: list[str]) -> DataFrame:
    """All paths of ``two_hop`` from a stored graph: both hops lie in the buckets of the partner, so no triple is shuffled."""
    one = spark.read.table(f"{name}_by_object").where(F.col("subject").ilike(origin_pattern) & (F.col("predicate") == first))
    two = spark.read.table(f"{name}_by_subject").where(F.col("predicate").isin(then) & ~F.col("object").ilike(origin_pattern))
    # triples are unique, so paths are
    hop1 = one.select(F.col("object").alias("partner"), F.col("subject").alias("company"), F.col("predicate").alias("hop1_rel"))
    hop2 = two.select(F.col("subject").alias("partner"), F.col("predicate").alias("hop2_rel"), F.col("object").alias("partners_partner"))
    return hop1.hint("merge").join(hop2, "partner").select("company", "hop1_rel", "partner", "hop2_rel", "partners_partner")


def stored_lookup(spark: SparkSession, name: str, names: list[str], limit: int = 20) -> DataFrame:
    """Up to ``limit`` relations of each of a few names from a stored graph: row groups without any of them are passed over."""
    def end(column: str) -> DataFrame:
        found = spark.read.table(f"{name}_by_{column}").where(F.col(column).isin(names))
        return found.select(F.col(column).alias("entity_name"), *TRIPLE)

    both = end("subject").unionByName(end("object").where(~F.col("subject").eqNullSafe(F.col("object"))))
    return _first_n(both, ["entity_name"], ["predicate", "subject", "object"], limit).select("entity_name", *TRIPLE)
