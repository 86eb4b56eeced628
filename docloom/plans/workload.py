"""One query per operator on the driver tables; ``oracles`` holds their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.operators import chunk as K
from docloom.operators import classify as C
from docloom.operators import context as H
from docloom.operators import extract as X
from docloom.operators import graph as G
from docloom.operators import parse as P
from docloom.operators import postings as PX
from docloom.operators import quality as Q
from docloom.operators import retrieve as R
from docloom.operators import summary as S
from docloom.operators import triplets as TR
from docloom.operators import embed as E
from docloom.plans import medallion as M
from docloom.plans import standin as D
from docloom.session import configure, scratch_folder
from docloom.session import materialize as store
from docloom.sources import files as SF
from docloom.sources import tables as ST
from docloom.streaming import counts as CV

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Tables:
    """The driver tables and the tables derived from them, for one session and scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return D.table(self.spark, self.sf_dir, name)

    def stored(self, name: str) -> DataFrame:
        return D.stored(self.spark, self.sf_dir, name)

    @property
    def index(self) -> PX.StoredIndex:
        """The stored index of the chunks."""
        return D.stored_index(self.spark, self.sf_dir, "chunks")

    @property
    def questions(self) -> DataFrame:
        return D.questions(self.spark, self.sf_dir)


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Tables(configure(spark, D.shuffle_bytes(spark, sf_dir)), sf_dir))

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# ------------------------------------------------------- sources and sinks ----
@query
def with_provenance(t: Tables) -> DataFrame:
    rows = SF.with_provenance(t("documents"))
    return rows.select("doc_id", T.file_name("source_path").alias("file"), F.col("ingested_at").isNotNull().alias("stamped"))


@query
def corpus_inventory(t: Tables) -> DataFrame:
    return SF.corpus_inventory(D.bronze(t.spark, t.sf_dir))


@query
def read_table(t: Tables) -> DataFrame:
    return ST.read_table(t.spark, f"{t.sf_dir}/supplier.parquet", "s_suppkey", "s_name", "s_acctbal")


@query
def append_positional(t: Tables) -> DataFrame:
    """Customers appended to suppliers although their columns come in another order."""
    base = t("supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    extra = t("customer").select(F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"))
    name = fresh_table("parties")
    ST.overwrite_table(base, name)
    ST.append_by_name(extra, name)
    return ST.read_table(t.spark, name)


@query
def ctas_grouped(t: Tables) -> DataFrame:
    return ST.overwrite_table(S.analysis_rows(t.stored("summary")), fresh_table("analysis"))


def fresh_table(label: str) -> str:
    """A table name of this call's own."""
    return f"docloom_{label}_{uuid.uuid4().hex}"


@query
def overwrite_table(t: Tables) -> DataFrame:
    """The second write replaces the first one's rows and columns."""
    name = fresh_table("orders")
    ST.overwrite_table(t("nation").select("n_name"), name)
    return ST.overwrite_table(t("orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders")), name)


@query
def materialized_view(t: Tables) -> DataFrame:
    named = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return ST.materialized_view(t.spark, fresh_table("customers"), lambda: named.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers")), {"quality": "gold"})


@query
def summary_view(t: Tables) -> DataFrame:
    """The summary kept up by batches: documents arrive as a stream, then toxic ones are taken away."""
    folder = f"{scratch_folder(t.spark)}/summary-{uuid.uuid4().hex}"
    gold = t.stored("gold").select("source_path", *S.SUMMARY_KEYS)
    gold.repartition(4, "source_path").write.parquet(f"{folder}/gold")
    view = CV.CountView(t.spark, f"{folder}/view", S.SUMMARY_KEYS, compact=3)
    arrivals = t.spark.readStream.schema(gold.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/gold")
    last = CV.count_stream(arrivals, view, f"{folder}/state").lastProgress["batchId"]
    toxic = t("labels").where("toxic = 1").join(t("documents"), "doc_id")
    toxic = toxic.select(D.raw_path(F.col("lang"), F.concat_ws("_", "source", F.col("doc_id").cast("string"))).alias("source_path")).distinct()
    gone = ST.read_table(t.spark, f"{folder}/gold").join(toxic, "source_path", "left_semi").withColumn(CV.SIGN, F.lit(-1))
    for _ in range(2):  # delivered twice, counted once
        view.apply(gone, last + 1)
    return view.read()


@query
def read_stream_table(t: Tables) -> DataFrame:
    """A stored table streamed into another; a second run finds nothing new."""
    folder = f"{scratch_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    t("supplier").select("s_suppkey", "s_name", "s_acctbal").write.parquet(f"{folder}/in")
    for _ in range(2):
        ST.streaming_table(ST.read_stream_table(t.spark, f"{folder}/in"), f"{folder}/out", f"{folder}/state")
    return ST.read_table(t.spark, f"{folder}/out")


def _files(files: DataFrame) -> DataFrame:
    """Size of each file as listed, and a digest of its content."""
    return files.select("file_size_bytes", F.sha2("content", 256).alias("content_sha256"))


@query
def ingest_batch(t: Tables) -> DataFrame:
    """A file for every document, read whole."""
    return _files(SF.ingest_batch(t.spark, D.text_files(t.spark, t.sf_dir), "*.txt"))


@query
def ingest_stream(t: Tables) -> DataFrame:
    """The same files as a stream; a second run finds nothing new."""
    folder = f"{scratch_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    for _ in range(2):
        files = SF.ingest_stream(t.spark, D.text_files(t.spark, t.sf_dir), "*.txt", 5000, f"{folder}/manifests")
        ST.streaming_table(_files(files), f"{folder}/out", f"{folder}/state")
    return ST.read_table(t.spark, f"{folder}/out")


@query
def extract_with_model(t: Tables) -> DataFrame:
    """A rule in the place of a user's model: it answers with the length of its prompt."""
    answer = lambda prompts: [f'{{"characters": {len(p)}}}' for p in prompts]
    return TR.extract_with_model(t("documents").select("doc_id", "text"), answer, "Read: ", text="text").select("doc_id", "result")


@query
def materialize(t: Tables) -> DataFrame:
    totals = t("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("l_suppkey").alias("suppliers"))
    return store(totals, "part-lines")


def _chunk_versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The chunk table before and after a revision; an index of it isn't asked for here.

    Chunks of toxic documents go, those of low-quality documents are rewritten,
    and earnings calls are new.
    """
    marks = t("labels").join(t("documents"), "doc_id").select(
        D.raw_path(F.col("lang"), F.concat_ws("_", "source", F.col("doc_id").cast("string"))).alias("source_path"),
        "quality", "toxic",
    )
    chunks = t.stored("chunks").select(*K.SEARCH_COLUMNS)
    marked = store(chunks.join(marks, "source_path", "left"), "marked")  # both versions are read from it, texts are shuffled once
    is_call = F.col("document_type") == "Earnings Call"
    old = marked.where(~F.coalesce(is_call, F.lit(False))).select(*K.SEARCH_COLUMNS)
    new = marked.where(F.coalesce(F.col("toxic") != 1, F.lit(True)))
    rewritten = F.when(F.col("quality") == 0, F.concat("chunk_to_embed", F.lit(" (revised)"))).otherwise(F.col("chunk_to_embed"))
    return old, new.withColumn("chunk_to_embed", rewritten).select(*K.SEARCH_COLUMNS)


@query
def chunk_changes(t: Tables) -> DataFrame:
    return ST.chunk_changes(*_chunk_versions(t))


@query
def apply_changes(t: Tables) -> DataFrame:
    old, new = _chunk_versions(t)
    path = f"{scratch_folder(t.spark)}/chunks-{uuid.uuid4().hex}"
    ST.write_bucketed(old, path)
    new = store(new, "revised")
    changes = store(ST.chunk_changes(ST.read_table(t.spark, path).drop("bucket"), new), "changes")
    return ST.apply_bucketed(t.spark, path, new, changes).select("chunk_id", "chunk_to_embed", "company", "document_type")


@query
def sync_index(t: Tables) -> DataFrame:
    """The index of the first version brought in step with the second: chunks, words, vectors and how many lists each is in."""
    old, new = _chunk_versions(t)
    index = PX.write_index(old, f"{scratch_folder(t.spark)}/index-{uuid.uuid4().hex}")
    PX.sync_index(index, new)
    listed = index.postings.select("bucket", F.explode("nos").alias("no")).groupBy("bucket", "no").agg(F.count(F.lit(1)).alias("n_lists"))
    vector = F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), " ")
    rows = index.chunks.join(listed, ["bucket", "no"], "left")
    return rows.select("chunk_id", "chunk_to_embed", F.array_join("tokens", " ").alias("words"), vector.alias("vector"), F.coalesce("n_lists", F.lit(0)).alias("n_lists"))


@query
def silver_stream(t: Tables) -> DataFrame:
    """Documents and conversation turns streamed in, silver streamed out, everything available now."""
    def stream(name: str) -> DataFrame:
        # as a glob, a table may be one file or a folder of files
        return t.spark.readStream.schema(t(name).schema).parquet(f"{t.sf_dir.rstrip('/')}/{{{name}}}.parquet")

    files = D.document_files(stream("documents")).unionByName(D.call_files(stream("conversations")))
    rows = M.silver(D.as_bronze(files), fmt="text", rules=D.FIELD_RULES, aliases=D.ALIASES)
    sink = f"{scratch_folder(t.spark)}/stream-{uuid.uuid4().hex}"
    ST.streaming_table(rows.drop("parsed_document", "ingested_at"), sink, f"{sink}.state")
    return ST.read_table(t.spark, sink)


# -------------------------------------------- projections and predicates ----
@query
def silver(t: Tables) -> DataFrame:
    """Ten silver columns, the VARIANT and the clock left out of the comparison."""
    return D.silver(t.spark, t.sf_dir).drop("parsed_document", "ingested_at")


@query
def gold(t: Tables) -> DataFrame:
    return D.gold(D.silver(t.spark, t.sf_dir)).drop("parsed_document", "ingested_at")


@query
def project_rename(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("chunk_id"), F.col("o_orderstatus").alias("document_type"), F.col("o_orderpriority").alias("company")
    )


@query
def drop_columns(t: Tables) -> DataFrame:
    return t("part").drop("p_retailprice", "p_size")


@query
def struct_project(t: Tables) -> DataFrame:
    packed = t("part").select("p_partkey", F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("made"))
    return packed.select("p_partkey", F.col("made.brand").alias("brand"), F.col("made.size").alias("size"))


@query
def not_null_filter(t: Tables) -> DataFrame:
    return t.stored("silver").where(F.col("fiscal_period").isNotNull()).select("source_path", "fiscal_period")


@query
def ilike_filter(t: Tables) -> DataFrame:
    return t.stored("silver").where(F.col("document_type").ilike("%earnings%")).select("source_path", "company")


@query
def like_filter(t: Tables) -> DataFrame:
    return t("part").where(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@query
def in_filter(t: Tables) -> DataFrame:
    return t.stored("relationships").where(F.col("predicate").isin("partners_with", "invests_in")).select(*G.TRIPLE)


@query
def not_ilike_filter(t: Tables) -> DataFrame:
    return t.stored("relationships").where(~F.col("object").ilike("brand%")).select(*G.TRIPLE)


@query
def not_equal_filter(t: Tables) -> DataFrame:
    rows = t.stored("summary").where((F.col("company") != "NVIDIA Corporation") & (F.col("ai_investment_category") != V.NOT_AI))
    return rows.select(*S.SUMMARY_KEYS, "document_count")


@query
def either_direction_filter(t: Tables) -> DataFrame:
    one, other = F.col("subject"), F.col("object")
    both = (one.ilike("nation%") & (other == "ASIA")) | ((one == "ASIA") & other.ilike("nation%"))
    return t.stored("relationships").where(both).select(*G.TRIPLE)


@query
def optional_predicate(t: Tables) -> DataFrame:
    return G.top_objects_by_predicate(t.stored("relationships"), limit=50)


@query
def fallback_columns(t: Tables) -> DataFrame:
    """Document names with and without extracted values, some outside the corpus root."""
    path = F.when(
        F.col("source") == "src7", F.concat(F.lit("/elsewhere/"), F.col("source"), F.lit("."), F.col("lang"))
    ).otherwise(D.raw_path(F.col("lang"), F.concat_ws("_", "source", F.col("doc_id").cast("string"))))
    found = X.extract_fields(F.col("text"), rules=D.FIELD_RULES)
    docs = D.spread(t("documents").select("doc_id", "source", "lang", "text"), "doc_id")
    rows = T.compute_once(docs.select("doc_id", path.alias("source_path"), "text"), found=found)
    rows = rows.select("doc_id", "source_path", F.col("found.document_type").alias("extracted_document_type"),
                       F.col("found.company").alias("extracted_company"))
    return X.fallback_columns(rows).select("doc_id", "document_type", "company")


@query
def distinct_rows(t: Tables) -> DataFrame:
    return t("lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query
def literal_columns(t: Tables) -> DataFrame:
    return t("nation").select(
        F.lit(V.UNKNOWN).alias("company"), F.col("n_name").alias("entity_name"), F.lit(V.BACKFILL_DESCRIPTION).alias("description")
    )


# ------------------------------------------------------------------ quality ----
@query
def expect_or_drop(t: Tables) -> DataFrame:
    rows = t("documents").select("doc_id", F.col("text").alias("plain_text"))
    return Q.expect_or_drop(rows, Q.SILVER_EXPECTATIONS[0]).select("doc_id", F.length("plain_text").alias("chars"))


@query
def expect_warn(t: Tables) -> DataFrame:
    return Q.expect_warn(t.stored("silver"), *Q.SILVER_EXPECTATIONS[1:]).select(
        "source_path", "has_company", "has_doc_type", "has_fiscal_period"
    )


@query
def expectation_report(t: Tables) -> DataFrame:
    return Q.expectation_report(D.silver_rows(t.spark, t.sf_dir))


@query
def completeness(t: Tables) -> DataFrame:
    return Q.completeness(t.stored("silver"), "company", "fiscal_period", "revenue_reported")


@query
def quality_gate(t: Tables) -> DataFrame:
    return Q.quality_gate(t.stored("silver"), t.stored("gold"))


@query
def pk_duplicates(t: Tables) -> DataFrame:
    """Order lines share order and part keys; whole texts of documents repeat."""
    return Q.pk_duplicates(t("lineitem"), "l_orderkey", "l_partkey")


@query
def chunk_id_duplicates(t: Tables) -> DataFrame:
    return K.duplicate_chunks(t.stored("search"))


@query
def flow_progress(t: Tables) -> DataFrame:
    return Q.flow_progress(D.event_log(t.spark, t.sf_dir))


# ------------------------------------------------- documents to fields ----
@query
def parse_document(t: Tables) -> DataFrame:
    pages = P.parse_document(D.spread(t("pages").select("page_id", "html"), "page_id"), "html", "html")
    rows = pages.select("page_id", F.explode("elements").alias("e"))
    return rows.select("page_id", F.col("e.id").alias("element_id"), F.col("e.type").alias("element_type"), "e.content")


@query
def parse_text(t: Tables) -> DataFrame:
    """Lines of whole documents, the first one a title."""
    docs = P.parse_document(D.spread(t("documents").select("doc_id", "text"), "doc_id"), "text", "text", title_first=True)
    rows = docs.select("doc_id", F.explode("elements").alias("e"))
    return rows.select("doc_id", F.col("e.id").alias("element_id"), F.col("e.type").alias("element_type"), "e.content")


@query
def plain_text(t: Tables) -> DataFrame:
    """Page text by way of the stored VARIANT."""
    pages = P.parse_document(D.spread(t("pages").select("page_id", "html"), "page_id"), "html", "html")
    kept = pages.select("page_id", P.to_variant(F.col("elements")).alias("parsed"))
    return kept.select("page_id", P.plain_text(P.from_variant("parsed")).alias("plain_text"))


@query
def extract_fields(t: Tables) -> DataFrame:
    docs = D.spread(t("documents").select("doc_id", "text"), "doc_id")
    found = T.compute_once(docs, found=X.extract_fields(F.col("text"), rules=D.FIELD_RULES))
    return found.select("doc_id", "found.*")


@query
def canonicalize(t: Tables) -> DataFrame:
    spelled = F.concat(F.upper("source"), F.lit(" "), F.col("lang"), F.lit(", Inc."))
    return t("documents").select("doc_id", X.canonicalize(spelled, D.ALIASES).alias("company"))


@query
def canonicalize_by_table(t: Tables) -> DataFrame:
    """Part names meet an alias table made of their own first words and whole names."""
    aliases = t("part").select(F.col("p_name").alias("alias"), F.col("p_type").alias("canonical")).unionByName(
        t("part").select(F.split("p_name", " ")[0].alias("alias"), F.col("p_brand").alias("canonical"))
    ).groupBy("alias").agg(F.min("canonical").alias("canonical"))
    names = t("part").select("p_partkey", F.concat("p_name", F.lit(" Corp")).alias("spelled"))
    return X.canonicalize_by_table(names, "spelled", aliases).select("p_partkey", "canonical")


@query
def classify(t: Tables) -> DataFrame:
    docs = D.spread(t("documents").select("doc_id", "text"), "doc_id")
    return docs.select(
        "doc_id",
        C.classify("text", V.AI_CATEGORIES, D.CATEGORY_LEXICON, V.NOT_AI).alias("category"),
        C.classify("text", V.MANAGEMENT_TONES, D.TONE_LEXICON, V.NEUTRAL_TONE).alias("tone"),
    )


def _judged(t: Tables) -> DataFrame:
    """Documents with the label that the saved model gives them."""
    docs = D.spread(t("documents").select("doc_id", "text"), "doc_id")
    return C.classify_with(docs, C.load_classifier(D.quality_model(t.spark, t.sf_dir)), ["low", "high"])


@query
def classify_model(t: Tables) -> DataFrame:
    return _judged(t).select("doc_id", "predicted")


@query
def classify_model_report(t: Tables) -> DataFrame:
    """What the saved model answered, and whether it is right for three of four documents it hasn't seen."""
    told = _judged(t).join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    right = (F.col("predicted") == "high") == (F.col("quality") == 1)
    unseen = D.held_out() & F.col("quality").isNotNull()
    return told.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(F.col("predicted").isin("low", "high")).alias("answered"),
        F.count_if(unseen).alias("unseen"),
        (F.count_if(unseen & right) >= 0.75 * F.count_if(unseen)).alias("accurate"),
    )


@query
def sentiment(t: Tables) -> DataFrame:
    docs = D.spread(t("documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", C.sentiment("text", D.POSITIVE, D.NEGATIVE).alias("sentiment"))


@query
def chunk_documents(t: Tables) -> DataFrame:
    return M.chunks(D.silver(t.spark, t.sf_dir))


@query
def chunk_pages(t: Tables) -> DataFrame:
    """Pages cut at their headings, title and header in front of the text."""
    pages = P.parse_document(D.spread(t("pages").select("page_id", "html"), "page_id"), "html", "html")
    return K.chunk_documents(pages, "page_id", max_chars=600, carry=[])


@query
def extract_triplets(t: Tables) -> DataFrame:
    rows = t.stored("silver").drop("parsed_document")
    return TR.extract_triplets(rows, "plain_text", D.TRIPLET_PATTERNS, words=D.TRIPLET_WORDS).select("source_path", "result")


@query
def parse_structured(t: Tables) -> DataFrame:
    """Extraction JSON read back, some of it cut short on the way."""
    broken = F.when(F.col("document_type") == "fr", F.expr("left(result, length(result) - 3)")).otherwise(F.col("result"))
    rows = TR.parse_structured(t.stored("triplets_raw").withColumn("result", broken))
    return rows.select(
        "source_path", "malformed",
        F.coalesce(F.size("parsed.data.entities"), F.lit(0)).alias("entities"),
        F.coalesce(F.size("parsed.data.relationships"), F.lit(0)).alias("relationships"),
    )


@query
def embed_text(t: Tables) -> DataFrame:
    docs = E.embed_text(D.spread(t("documents").select("doc_id", "text"), "doc_id"), "text")
    return docs.select("doc_id", F.posexplode("vector").alias("slot", "value")).where(F.col("value") != 0)


# --------------------------------------------------------------- aggregates ----
@query
def investment_summary(t: Tables) -> DataFrame:
    """From raw files to the summary in one plan."""
    return S.ordered_summary(S.investment_summary(D.gold(D.silver(t.spark, t.sf_dir))))


@query
def summary_listing(t: Tables) -> DataFrame:
    return S.summary_listing(t.stored("summary"))


@query
def category_mix(t: Tables) -> DataFrame:
    return S.category_mix(t.stored("gold"))


@query
def category_leaders(t: Tables) -> DataFrame:
    return S.category_leaders(t.stored("summary"))


@query
def category_by_company(t: Tables) -> DataFrame:
    return S.category_by_company(t.stored("summary"))


@query
def signals_for_companies(t: Tables) -> DataFrame:
    return S.signals_for_companies(t.stored("summary"), ["NVIDIA Corporation", "Apple Inc."])


@query
def analysis_rows(t: Tables) -> DataFrame:
    return S.analysis_rows(t.stored("summary"))


@query
def entity_type_counts(t: Tables) -> DataFrame:
    return G.entity_type_counts(t.stored("all_entities"))


@query
def predicate_counts(t: Tables) -> DataFrame:
    return G.predicate_counts(t.stored("relationships"))


@query
def shared_targets(t: Tables) -> DataFrame:
    return G.shared_targets(t.stored("relationships"), H.CONTEXT_PREDICATES)


@query
def shared_target_members(t: Tables) -> DataFrame:
    return G.shared_target_members(t.stored("relationships"), H.CONTEXT_PREDICATES)


@query
def object_frequency(t: Tables) -> DataFrame:
    return G.object_frequency(t.stored("relationships"), "%Supplier%")


@query
def partnership_mentions(t: Tables) -> DataFrame:
    return G.partnership_mentions(t.stored("text_relationships"), sorted(D.SUBJECT_ALIASES), ["partners_with", "invests_in"])


@query
def top_objects_by_predicate(t: Tables) -> DataFrame:
    return G.top_objects_by_predicate(t.stored("relationships"), "acquires", "customer%")


@query
def table_counts(t: Tables) -> DataFrame:
    stored = {name: t.stored(name) for name in ("silver", "gold", "summary")}
    return S.table_counts({"bronze": D.bronze(t.spark, t.sf_dir), **stored})


@query
def company_breakdown(t: Tables) -> DataFrame:
    return S.company_breakdown(t.stored("gold"))


@query
def chunk_stats(t: Tables) -> DataFrame:
    return K.chunk_stats(t.stored("search"))


# ------------------------------------------------ windows, order, set forms ----
@query
def assign_uid(t: Tables) -> DataFrame:
    return G.assign_uid(G.dedupe_entities(D.star_entity_mentions(t.spark, t.sf_dir)))


@query
def side_row_number(t: Tables) -> DataFrame:
    """Both ids of every edge, looked up rather than numbered again."""
    return G.edge_table(t.stored("relationships"), t.stored("all_entities")).select("node_start_id", "relationship", "node_end_id").distinct()


@query
def share_of_total(t: Tables) -> DataFrame:
    counted = t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("lines"))
    total = F.sum("lines").over(G.Window.partitionBy("l_returnflag"))
    return counted.withColumn("pct", F.round(F.col("lines") * 100.0 / total, 1).cast("double"))


@query
def ordered_output(t: Tables) -> DataFrame:
    return S.ordered_summary(t.stored("summary"))


@query
def top_n(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query
def top_k_per_query(t: Tables) -> DataFrame:
    """The five dearest orders of every customer."""
    rows = t("orders").select(F.col("o_custkey").alias("query_id"), F.col("o_orderkey").alias("item_id"), F.col("o_totalprice").alias("score"))
    return R.top_k_per_query(rows, 5)


@query
def dedupe_entities(t: Tables) -> DataFrame:
    return G.dedupe_entities(TR.entity_mentions(TR.parse_structured(t.stored("triplets_raw"))))


@query
def dedupe_relationships(t: Tables) -> DataFrame:
    return G.dedupe_relationships(TR.relationship_mentions(TR.parse_structured(t.stored("triplets_raw"))))


@query
def entities_with_backfill(t: Tables) -> DataFrame:
    return G.entities_with_backfill(t.stored("entities"), t.stored("relationships"))


@query
def sanitize_identifier(t: Tables) -> DataFrame:
    login = F.concat(F.lit("."), F.col("c_name"), F.lit("+"), F.col("c_mktsegment"), F.lit("-@example.com"))
    return t("customer").select("c_custkey", T.sanitize_identifier(login).alias("schema_name"))


@query
def run_history(t: Tables) -> DataFrame:
    return S.run_history(D.runs(t.spark, t.sf_dir))


# -------------------------------------------------------------------- graph ----
@query
def build_entities(t: Tables) -> DataFrame:
    """From extraction JSON to numbered entities."""
    return G.build_entities(TR.entity_mentions(TR.parse_structured(t.stored("triplets_raw"))))


@query
def build_relationships(t: Tables) -> DataFrame:
    """Every triple of the star schema with its mentions."""
    return G.build_relationships(D.star_mentions(t.spark, t.sf_dir))


@query
def missing_entities(t: Tables) -> DataFrame:
    return G.missing_entities(t.stored("relationships"), t.stored("entities"))


@query
def backfill_entities(t: Tables) -> DataFrame:
    return G.backfill_entities(t.stored("relationships"), t.stored("entities"))


@query
def node_table(t: Tables) -> DataFrame:
    return G.node_table(t.stored("all_entities"))


@query
def edge_table(t: Tables) -> DataFrame:
    return G.edge_table(t.stored("relationships"), t.stored("all_entities")).withColumn(
        "edge_properties", F.to_json("edge_properties")
    )


@query
def relations_of_subject(t: Tables) -> DataFrame:
    return G.relations_of_subject(t.stored("relationships"), "customer%", "acquires")


@query
def two_hop(t: Tables) -> DataFrame:
    return G.two_hop(t.stored("relationships"), "supplier%", "partners_with", ["partners_with", "invests_in"])


@query
def two_hop_all(t: Tables) -> DataFrame:
    """Every supplier -> product -> brand path, no limit."""
    return G.two_hop(t.stored("relationships"), "supplier%", "supplies_to", ["uses_technology"], limit=None)


@query
def two_hop_stored(t: Tables) -> DataFrame:
    """The same paths from triples stored in buckets of both ends."""
    return G.stored_two_hop(t.spark, D.stored_graph(t.spark, t.sf_dir), "supplier%", "supplies_to", ["uses_technology"])


@query
def entity_lookup_stored(t: Tables) -> DataFrame:
    return G.stored_lookup(t.spark, D.stored_graph(t.spark, t.sf_dir), ["NATION_3", "ASIA", "Brand#11", "BUILDING"])


@query
def pair_relations(t: Tables) -> DataFrame:
    return G.pair_relations(t.stored("relationships"), "customer%", "BUILDING")


@query
def title_join(t: Tables) -> DataFrame:
    return G.title_join(t.stored("all_entities"), t.stored("relationships"))


@query
def entity_lookup(t: Tables) -> DataFrame:
    return G.entity_lookup(t.stored("relationships"), "NATION_3")


@query
def entity_lookup_batch(t: Tables) -> DataFrame:
    """Up to twenty relations of every known entity."""
    return G.entity_lookup_batch(t.stored("relationships"), t.stored("all_entities").select("entity_name"))


@query
def pattern_match(t: Tables) -> DataFrame:
    return G.pattern_match(t.stored("relationships"), t.stored("all_entities"), "Product", "uses_technology", "Product")


# ---------------------------------------------------------------- retrieval ----
def _vectors(t: Tables) -> DataFrame:
    """Vectors with the metadata of the document of the same number."""
    about = t("documents").select(F.col("doc_id").alias("vec_id"), "lang", "source")
    return t("embeddings").join(about, "vec_id", "left")


@query
def vector_topk(t: Tables) -> DataFrame:
    """Every vector asks for its five nearest others."""
    every = t("embeddings")
    return R.vector_topk(every, every, 5, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                         item_vector="embedding", skip_same=True)


@query
def query_doc_join(t: Tables) -> DataFrame:
    """Questions against chunk vectors with the requested columns, score last."""
    chunks = t.stored("search")
    ranking = R.vector_topk(t.questions, chunks, 5)
    return R.with_columns(ranking, chunks, ["company", "fiscal_period", "document_type", "chunk_text"])


@query
def vector_topk_filtered(t: Tables) -> DataFrame:
    return R.vector_topk(t("embeddings"), _vectors(t), 5, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                         item_vector="embedding", filters='{"lang": "de"}')


@query
def vector_topk_like(t: Tables) -> DataFrame:
    return R.vector_topk(t("embeddings"), _vectors(t), 5, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                         item_vector="embedding", filters='{"source LIKE": "src1"}')


@query
def vector_topk_by_label(t: Tables) -> DataFrame:
    """Neighbours with the query's own label: one filter value per query."""
    every = t("embeddings")
    return R.vector_topk(every, every, 5, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                         item_vector="embedding", query_only="label", item_only="label", skip_same=True)


@query
def ann_topk(t: Tables) -> DataFrame:
    every = t("embeddings")
    return R.ann_topk(every, every, 10, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                      item_vector="embedding", skip_same=True)


@query
def ann_all_lists(t: Tables) -> DataFrame:
    """The same routing with every list probed, which makes it exact."""
    every = t("embeddings")
    centroids = R.train_centroids(every, "embedding")
    return R.ann_topk(every, every, 5, query_id="vec_id", item_id="vec_id", query_vector="embedding",
                      item_vector="embedding", centroids=centroids, probes=len(centroids), skip_same=True)


@query
def search(t: Tables) -> DataFrame:
    """Hybrid search of the earnings calls alone, with requested columns."""
    return R.search(t.questions, t.index, ["company", "fiscal_period", "document_type"], 5, "HYBRID",
                    '{"document_type LIKE": "Earnings"}')


@query
def bm25_topk(t: Tables) -> DataFrame:
    return R.bm25_topk(t.questions, t.index, 10)


@query
def bm25_documents(t: Tables) -> DataFrame:
    """Keyword ranking over whole documents."""
    docs = D.spread(t("documents").select("doc_id", "text"), "doc_id")
    return R.bm25_topk(t.questions, docs, 10, item_id="doc_id", item_text="text")


@query
def hybrid_topk(t: Tables) -> DataFrame:
    return R.hybrid_topk(t.questions, t.index, 10)


@query
def compare_rankings(t: Tables) -> DataFrame:
    """Meaning against words, side by side; rank 0 where a ranking does not have the item."""
    chunks = t.stored("search")
    both = R.compare_rankings(R.vector_topk(t.questions, chunks, 10), R.bm25_topk(t.questions, t.index, 10))
    return both.fillna(0, ["left_rank", "right_rank"])


@query
def citations(t: Tables) -> DataFrame:
    chunks = t.stored("search")
    return R.citations(R.with_columns(R.bm25_topk(t.questions, t.index, 10), chunks, ["source_path"]))


@query
def verbatim_hits(t: Tables) -> DataFrame:
    return R.verbatim_hits(t.questions, D.spread(t("documents").select("doc_id", "text"), "doc_id"), item_id="doc_id", text="text")


@query
def retrieval_eval(t: Tables) -> DataFrame:
    """Whether keyword ranking finds the documents that hold the question's passage."""
    docs = D.stored_index(t.spark, t.sf_dir, "documents")
    ranking = R.bm25_topk(t.questions, docs, 10)
    docs = docs.chunks
    return R.retrieval_eval(ranking, R.verbatim_hits(t.questions, docs, item_id="doc_id", text="text"))


@query
def entity_link(t: Tables) -> DataFrame:
    chunks = t.stored("search")
    return G.entity_link(R.bm25_topk(t.questions, t.index, 5), chunks, t.stored("text_relationships"))


# ------------------------------------------------------------------ context ----
def _targets(t: Tables) -> DataFrame:
    ranking = R.with_columns(R.bm25_topk(t.questions, t.index, 5), t.stored("search"), ["company"])
    return H.context_targets(t.questions, ranking.select("query_id", "company"))


@query
def context_targets(t: Tables) -> DataFrame:
    return _targets(t)


@query
def single_company_filter(t: Tables) -> DataFrame:
    return t.questions.select("query_id", H.single_company("companies").alias("company"))


@query
def company_relations(t: Tables) -> DataFrame:
    return H.company_relations(_targets(t), t.stored("text_relationships"), aliases=D.SUBJECT_ALIASES)


@query
def company_signals(t: Tables) -> DataFrame:
    return H.company_signals(_targets(t), t.stored("summary"))


@query
def format_lines(t: Tables) -> DataFrame:
    relations = t.stored("relationships").select(*G.TRIPLE, F.col("mention_count").alias("mentions"))
    signals = t.stored("summary").where(F.col("company").isNotNull()).groupBy("company", "ai_investment_category").agg(
        F.sum("document_count").alias("total_docs")
    )
    return H.format_lines(relations, signals)


def _parts(t: Tables) -> DataFrame:
    return H.hybrid_context(t.questions, t.index, t.stored("text_relationships"), t.stored("summary"), aliases=D.SUBJECT_ALIASES)


@query
def hybrid_context(t: Tables) -> DataFrame:
    return _parts(t)


@query
def assemble_context(t: Tables) -> DataFrame:
    return H.assemble_context(_parts(t))


@query
def build_prompt(t: Tables) -> DataFrame:
    return H.build_prompt(H.assemble_context(_parts(t)), t.questions)
