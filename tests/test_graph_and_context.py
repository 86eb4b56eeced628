import json

import pytest
from pyspark.sql import functions as F

from docloom.operators import context as H
from docloom.operators import graph as G
from docloom.operators import triplets as TR
from docloom.plans import standin as D

TEXT = (
    "Alpha Corp partners with Beta. Alpha Corp competes with Gamma Labs. Beta invested in Delta. Gamma Labs acquired Epsilon. "
    "Beta uses Quantum Core. Delta supplies to Alpha Corp. Jane Doe mentioned Quantum Core. Alpha Corp partners with Beta."
)


def extracted(spark):
    docs = spark.createDataFrame(
        [("d1", "X", "Q1", TEXT), ("d2", "W", "Q1", "Alpha Corp partnered with Beta in the end."), ("d3", None, None, "nothing"), ("d4", "X", "Q1", None)],
        "doc string, company string, fiscal_period string, plain_text string",
    )
    return TR.extract_triplets(docs)


def test_every_predicate_is_extracted(spark):
    found = {r.doc: r.result for r in extracted(spark).collect()}
    data = json.loads(found["d1"])["data"]
    assert [(r["subject"], r["predicate"], r["object"]) for r in data["relationships"]] == [
        ("Alpha Corp", "partners_with", "Beta"), ("Alpha Corp", "partners_with", "Beta"),
        ("Alpha Corp", "competes_with", "Gamma Labs"), ("Beta", "invests_in", "Delta"), ("Gamma Labs", "acquires", "Epsilon"),
        ("Beta", "uses_technology", "Quantum Core"), ("Delta", "supplies_to", "Alpha Corp"), ("Jane Doe", "mentions", "Quantum Core"),
    ]
    assert {"name": "Jane Doe", "entity_type": "Person", "description": "Jane Doe mentioned Quantum Core"} in data["entities"]
    assert json.loads(found["d3"]) == {"data": {"entities": [], "relationships": []}} and found["d4"] is None


def test_unknown_predicates_are_refused():
    with pytest.raises(ValueError, match="befriends"):
        TR.triplet_json("x", [("befriends", "(a) (b)", "Person", "Person")])


def test_model_hook_answers_per_batch(spark):
    docs = spark.createDataFrame([("a",), (None,), ("b",)], "plain_text string")
    got = TR.extract_with_model(docs, lambda asked: [a.upper() for a in asked], "p:").collect()
    assert {r.plain_text: r.result for r in got} == {"a": "P:A", "b": "P:B", None: None}


def test_malformed_json_is_flagged_and_vanishes(spark):
    bad = spark.createDataFrame(
        [("X", "Q", '{"data":{"entities":['), ("X", "Q", "[1]"), ("X", "Q", '{"data":{"entities":[]}}'), ("X", "Q", None),
         ("X", "Q", '{"data":{"entities":[{"name":"n","entity_type":"t","description":"d"}],"relationships":[]}}')],
        "company string, fiscal_period string, result string",
    )
    parsed = TR.parse_structured(bad)
    assert sorted(r.malformed for r in parsed.collect()) == [False, False, True, True, True]
    assert TR.entity_mentions(parsed).count() == 1 and TR.relationship_mentions(parsed).count() == 0


def graph(spark):
    parsed = TR.parse_structured(extracted(spark))
    return G.build_entities(TR.entity_mentions(parsed)), G.build_relationships(TR.relationship_mentions(parsed))


def test_dedupe_keeps_the_smallest_and_counts(spark):
    entities, relationships = graph(spark)
    pair = relationships.where("subject = 'Alpha Corp' and object = 'Beta'").collect()
    assert [(r.company, r.mention_count) for r in pair] == [("W", 3)]
    assert entities.where("entity_name = 'Alpha Corp'").count() == 1
    kinds = {(r.entity_name, r.entity_type) for r in entities.collect()}
    assert ("Quantum Core", "Technology") in kinds and ("Quantum Core", "Product") in kinds


def test_uid_equals_row_number_past_999(spark, rows):
    names = spark.range(1001).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("entity_name"), F.lit("Company").alias("entity_type"))
    names = names.unionByName(spark.createDataFrame([("n1", "Person"), ("q", "Person"), ("z", None)], "entity_name string, entity_type string"))
    entities = names.select(F.lit("c").alias("company"), F.lit("p").alias("fiscal_period"), "entity_name", "entity_type", F.lit("d").alias("description"))
    got = G.assign_uid(entities)
    assert rows(got) == rows(G.assign_uid_windowed(entities))
    ids = {r.UID for r in got.where("entity_type = 'Company'").collect()}
    assert len(ids) == 1001 and {"Company_001", "Company_999", "Company_1000", "Company_1001"} <= ids


RELATIONS = [
    ("NVIDIA", "partners_with", "Hub"), ("NVIDIA Corp", "partners_with", "Hub"), ("NVIDIA", "partners_with", "Solo"),
    ("Hub", "partners_with", "T1"), ("Hub", "invests_in", "T2"), ("Hub", "partners_with", "NVIDIA"), ("Hub", "mentions", "T3"),
    ("Solo", "invests_in", "T1"), ("Other", "partners_with", "T1"), ('Quo"te', "mentions", "T1"), ("NVIDIA", "supplies_to", "Meta"),
]


def relationships_of(spark, triples, n=1):
    return spark.createDataFrame([("c", "p", *t, n) for t in triples],
                                 "company string, fiscal_period string, subject string, predicate string, object string, mention_count bigint")


def test_two_hop_limit_is_the_head_of_all_paths(spark):
    rel = relationships_of(spark, RELATIONS + [("Hub", "partners_with", f"T{i}") for i in range(10, 40)])
    every = G.two_hop(rel, "NVIDIA%", "partners_with", ["partners_with", "invests_in"], limit=None).collect()
    order = lambda r: (r.partner, r.partners_partner, r.hop2_rel, r.company, r.hop1_rel)
    for limit in (1, 5, 20, 500):
        got = G.two_hop(rel, "NVIDIA%", "partners_with", ["partners_with", "invests_in"], limit).collect()
        assert [tuple(r) for r in got] == [tuple(r) for r in sorted(every, key=order)[:limit]]
    assert all(not r.partners_partner.startswith("NVIDIA") for r in every)


def test_questions_on_the_graph(spark, rows):
    rel = relationships_of(spark, RELATIONS, 2)
    assert rows(G.shared_targets(rel, ["partners_with", "invests_in"], 3)) == [("T1", 3)]
    assert rows(G.shared_target_members(rel, ["partners_with", "invests_in"], 3)) == [("T1", 3, "Hub"), ("T1", 3, "Other"), ("T1", 3, "Solo")]
    assert rows(G.object_frequency(rel, "%NVIDIA%")) == [("Meta", 2)]
    assert rows(G.top_objects_by_predicate(rel, limit=1)) == [("T1", 8)]
    assert rows(G.relations_of_subject(rel, "nvidia", "SUPPLIES_TO")) == [("NVIDIA", "supplies_to", "Meta", "p")]
    assert rows(G.pair_relations(rel, "nvidia%", "Hub")) == [
        ("Hub", "partners_with", "NVIDIA", "c", "p"), ("NVIDIA Corp", "partners_with", "Hub", "c", "p"), ("NVIDIA", "partners_with", "Hub", "c", "p")]
    one = [tuple(r) for r in G.entity_lookup(rel, "Hub", limit=3).collect()]
    names = spark.createDataFrame([("Hub",), ("Nobody",), ("Hub",)], "entity_name string")
    many = G.entity_lookup_batch(rel, names, limit=3).orderBy("predicate", "subject", "object").collect()
    assert one == [tuple(r)[1:] for r in many] and {r.entity_name for r in many} == {"Hub"}
    assert G.entity_lookup(rel, "Hub", "mentions").count() == 1


def test_edges_keep_their_count_and_known_ids(spark):
    rel = relationships_of(spark, RELATIONS)
    known = spark.createDataFrame(
        [("c", "p", "Hub", "Unknown", "d", "Unknown_009"), ("c", "p", "Hub", "Company", "d", "Company_001"), ("c", "p", "T1", "Product", "d", "Product_001")],
        G.ENTITY_COLUMNS,
    )
    entities = G.entities_with_backfill(known, rel)
    edges = G.edge_table(rel, entities).collect()
    ids = {r.UID for r in entities.collect()}
    assert len(edges) == len(RELATIONS) and {e.node_start_id for e in edges} | {e.node_end_id for e in edges} <= ids
    assert {e.node_end_id for e in edges if e.object == "Hub"} == {"Company_001"}
    quoted = next(e for e in edges if e.subject.startswith("Quo"))
    assert json.loads(quoted.node_start_properties) == {"_label": 'Quo"te'}
    bare = G.edge_table(rel, known).where("subject = 'Solo'").first()
    assert (bare.node_start_id, bare.node_start_key, bare.node_end_key) == (None, "entity", "Product")
    assert {r.entity_name for r in G.missing_entities(rel, known).collect()}.isdisjoint({"Hub", "T1"})
    matched = G.pattern_match(rel, known, "Company", "partners_with", "Product").collect()
    assert [(r.start_id, r.end_id) for r in matched] == [("Company_001", "Product_001")]


def test_title_join(spark):
    people = spark.createDataFrame([("c", "p", "Amy", "Person", "Chief Officer", "P_1"), ("c", "p", "Bob", "Person", "Clerk", "P_2"),
                                    ("c", "p", "Amy", "Company", "chief", "C_1")], G.ENTITY_COLUMNS)
    rel = relationships_of(spark, [("Amy", "mentions", "GPU"), ("Bob", "mentions", "GPU")])
    assert [tuple(r) for r in G.title_join(people, rel).collect()] == [("Amy", "Chief Officer", "mentions", "GPU")]


def test_entity_link_matches_names_of_several_words(spark, rows):
    rel = relationships_of(spark, [("Alpha Corp", "acquires", "Z"), ("Beta", "acquires", "Y"), ("Corp", "mentions", "W")])
    chunks = spark.createDataFrame([("k1", "So alpha corp, it said"), ("k2", "beta")], "chunk_id string, chunk_text string")
    ranking = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "gone")], "query_id int, item_id string")
    assert rows(G.entity_link(ranking, chunks, rel)) == [(1, "Alpha Corp", "acquires", "Z", 1), (1, "Corp", "mentions", "W", 1), (2, "Beta", "acquires", "Y", 1)]


def context_inputs(spark):
    from docloom.operators.embed import embed_text

    questions = embed_text(spark.createDataFrame(
        [(1, "apple chips", ["Apple Inc."]), (2, "nvidia gpu partners", None), (3, "zzz", ["Apple Inc.", "NVIDIA Corporation"])],
        "query_id int, question string, companies array<string>"), "question")
    chunks = embed_text(spark.createDataFrame(
        [("a0", "apple chips and silicon", "Apple Inc.", "FY24Q1", "10-K"), ("n0", "nvidia gpu partners " + "x" * 1500, "NVIDIA Corporation", None, "10-Q")],
        "chunk_id string, chunk_text string, company string, fiscal_period string, document_type string"), "chunk_text")
    rel = relationships_of(spark, [("Apple", "invests_in", "Chips"), ("NVIDIA", "partners_with", "TSMC"), ("NVIDIA", "mentions", "X")] +
                           [("NVIDIA", "uses_technology", f"t{i:03d}") for i in range(50)], 3)
    summary = spark.createDataFrame(
        [("Apple Inc.", "FY24Q1", "10-K", "AI Infrastructure", "Positive", 4), ("Apple Inc.", "FY24Q2", "10-K", "AI Infrastructure", "Neutral", 1),
         ("Apple Inc.", "FY24Q1", "10-K", "Not AI-related", "Positive", 9)],
        "company string, fiscal_period string, document_type string, ai_investment_category string, management_sentiment string, document_count bigint")
    return questions, chunks, rel, summary


def test_hybrid_context_sections(spark):
    questions, chunks, rel, summary = context_inputs(spark)
    parts = H.hybrid_context(questions, chunks, rel, summary, max_chunks=5)
    text = {}
    for r in parts.orderBy("query_id", "section", "ord").collect():
        text.setdefault(r.query_id, {}).setdefault(r.section, []).append(r.text)
    assert [text[1][s][0] for s in (0, 1, 2)] == H.HEADINGS
    # one asked-for company restricts retrieval, relations and signals
    assert text[1][0][1:] == ["⬇️ [Apple Inc. | FY24Q1 | 10-K] ⬇️", "apple chips and silicon", "⬆️  ⬆️\n"]
    assert text[1][1][1:] == [f"{'Apple':<30} → {'invests_in':<20} → {'Chips':<30} (3 mentions)"]
    assert text[1][2][1:] == [f"{'Apple Inc.':<30}: {'AI Infrastructure':<30} — 5 documents"]
    assert "[NVIDIA Corporation | None | 10-Q]" in text[2][0][1]
    assert len(text[2][1]) == 1 + H.GRAPH_LINES and len(text[3][1]) == 1 + H.GRAPH_LINES
    assert text[3][1][1].startswith("Apple ")


def test_targets_fall_back_in_order(spark):
    questions = spark.createDataFrame([(1, ["A"]), (2, None), (3, None), (4, [])], "query_id int, companies array<string>")
    seen = spark.createDataFrame([(1, "B"), (2, "B"), (2, "B"), (2, None), (3, None)], "query_id int, company string")
    got = {}
    for r in H.context_targets(questions, seen).collect():
        got.setdefault(r.query_id, set()).add(r.company)
    assert got[1] == {"A"} and got[2] == {"B"} and len(got[3]) == 5 and len(got[4]) == 5


def test_assembled_context_cuts_each_part(spark):
    questions, chunks, rel, summary = context_inputs(spark)
    parts = H.hybrid_context(questions, chunks, rel, summary, max_chunks=5)
    context = H.assemble_context(parts)
    by_hand = {}
    for r in parts.orderBy("query_id", "section", "ord").collect():
        by_hand[r.query_id] = by_hand.get(r.query_id, "") + r.text[:1000]
    assert {r.query_id: r.context for r in context.collect()} == by_hand
    prompt = H.build_prompt(context, questions).where("query_id = 1").first().prompt
    assert by_hand[1] in prompt and prompt.endswith("Question: apple chips\n")


def test_entity_link_answers_from_as_many_tasks_as_there_are_slots(spark, rows):
    """One name has all relations: its answer, far longer than what is joined, still comes from several tasks."""
    rel = spark.createDataFrame([("c", "p", "Hub", "mentions", f"o{k}", 1) for k in range(400)], "company string, fiscal_period string, subject string, predicate string, object string, mention_count long")
    chunks = spark.createDataFrame([("a", "of the hub"), ("b", "none")], "chunk_id string, chunk_text string").repartition(40)
    ranking = spark.createDataFrame([(q, i) for q in range(5) for i in "ab"], "query_id int, item_id string")
    linked = G.entity_link(ranking, chunks, rel)
    per_task = [r["count"] for r in linked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2000 and len(per_task) > 1 and max(per_task) < 1500


def test_a_task_without_texts_builds_no_automaton(spark, monkeypatch):
    names = spark.createDataFrame([("hub",)], "_name string")
    texts = spark.createDataFrame([(1, ["hub"])], "query_id int, _words array<string>").where("query_id > 1")
    monkeypatch.setattr(G, "Mentions", None)  # calling it would fail
    assert G.mentions(texts, names).collect() == []


def test_triples_are_sorted_once_and_counted_before_the_shuffle(spark):
    schema = "company string, fiscal_period string, subject string, predicate string, object string"
    often = [("B", "Q2", "a", "p", "x")] * 500 + [("A", "Q9", "a", "p", "x"), (None, "Q3", "b", "p", None), ("A", None, "b", "p", None), (None, None, None, "p", "x")]
    mentions = spark.createDataFrame(often, schema).coalesce(1)
    assert G.counted_mentions(mentions).count() == 5
    found = G.build_relationships(mentions)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(
        [("A", "Q9", "a", "p", "x", 501), (None, "Q3", "b", "p", None, 2), (None, None, None, "p", "x", 1)], key=repr
    )
    assert G.build_relationships(mentions.limit(0)).count() == 0


def test_only_stretches_with_a_patterns_words_are_searched(spark):
    texts = ["One with two. Three.four with five with six.Seven with", "seven with eight", ".a1 with bb with ccc. ddd with eee", "x.\nÉté with voilà.", "no. hit. here", "", ".", None,
             "aaa with bbb.ccc with ddd with with with eee.fff", "aaa or bbb.or. ccc or ddd with eee. with fff"]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, plain_text string")
    plain = TR.extract_triplets(docs, patterns=D.TRIPLET_PATTERNS).collect()
    assert TR.extract_triplets(docs, patterns=D.TRIPLET_PATTERNS, words=D.TRIPLET_WORDS).collect() == plain
    assert sum("description" in (r.result or "") for r in plain) == 6
    left = docs.select(TR.stretches_with(F.split("plain_text", r"\.", -1), " with ", ".").alias("t")).collect()
    assert [r.t for r in left][:2] == ["One with two.four with five with six", "seven with eight"]
    assert all(rx.count(f"){D.TRIPLET_WORDS[p]}(") == 1 for p, rx, _, _ in D.TRIPLET_PATTERNS)


def plan_of(df):
    """The plan of a collected DataFrame as it was run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def named_graph(spark, tmp_path):
    """A stored graph whose files are far smaller than its names are in memory."""
    entities = spark.range(2000).selectExpr("'X' company", "'Q' fiscal_period", "concat('name number ', id) entity_name", "'Company' entity_type", "'d' description", "concat('Company_', id) UID")
    triples = spark.range(2000).selectExpr("'X' company", "'Q' fiscal_period", "concat('name number ', id) subject", "'mentions' predicate", "concat('name number ', id + 1) object", "1L mention_count")
    entities.write.parquet(f"{tmp_path}/entities")
    triples.write.parquet(f"{tmp_path}/triples")
    return spark.read.parquet(f"{tmp_path}/triples"), spark.read.parquet(f"{tmp_path}/entities")


def test_known_names_are_not_gathered_in_the_driver_to_find_missing_ones(spark, tmp_path):
    triples, entities = named_graph(spark, tmp_path)
    missing = G.missing_entities(triples, entities)
    assert "Broadcast" not in plan_of(missing)
    assert [r.entity_name for r in missing.collect()] == ["name number 2000"]


def test_a_table_of_many_rows_is_not_broadcast(spark, tmp_path, monkeypatch):
    triples, entities = named_graph(spark, tmp_path)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 1999)
    assert "Broadcast" not in plan_of(triples.join(D.join_side(entities), F.col("subject") == F.col("entity_name")))
    monkeypatch.setattr(D, "BROADCAST_ROWS", 2000)
    assert "Broadcast" in plan_of(triples.join(D.join_side(entities), F.col("subject") == F.col("entity_name")))


def test_nodes_of_edges_are_not_gathered_in_the_driver(spark, tmp_path):
    triples, entities = named_graph(spark, tmp_path)
    edges = G.edge_table(triples, entities).drop("edge_properties")
    assert "Broadcast" not in plan_of(edges)
    assert edges.count() == 2000 and edges.where("node_end_id is null").count() == 1


def test_asked_names_are_not_gathered_in_the_driver(spark, tmp_path):
    triples, entities = named_graph(spark, tmp_path)
    found = G.entity_lookup_batch(triples, entities.select("entity_name"))
    assert "Broadcast" not in plan_of(found)
    assert found.count() == 3999
