"""The driver tables seen as a document corpus, a graph and a question set.

There are no filings among them, so their columns play the parts: language and
source name make a path, conversation turns are earnings calls, and the star
schema is a property graph. Every row and every whole text takes part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions import text as T
from docloom.functions import vocab as V
from docloom.operators import classify as C
from docloom.operators import graph as G
from docloom.operators import postings as PX
from docloom.operators import summary as S
from docloom.operators import triplets as X
from docloom.operators.embed import embed_text
from docloom.plans import medallion as M
from docloom.session import materialize, scratch_folder

# --- fixed values: rules that fit the invented prose -------------------------
COMPANY_OF_SOURCE = {
    "Amazon.com, Inc.": ["src0", "src5", "src10", "src15"],
    "Apple Inc.": ["src1", "src6", "src11", "src16", "apache"],
    "Meta Platforms, Inc.": ["src2", "src7", "src12", "src17"],
    "Microsoft Corporation": ["src3", "src8", "src13", "assistant"],
    "NVIDIA Corporation": ["src4", "src9", "src14", "user"],
}
FIELD_RULES = {
    "company": [(r"(Apache) License", 1)],
    "fiscal_period": [
        (r"(?:^|[^\p{L}])[Tt]he (\p{L}{2})[^\p{L}]", 1),
        (r"(?:^|[^\p{L}])(?:der|la|le) (\p{L}{2,3})[^\p{L}]", 1),
    ],
    "document_type": [(r"Licensed under (CC [A-Z-]+)", 1)],
    "revenue": [(r"[Vv]ersion ([0-9]+)", 1)],
    "net_income": [(r"CC [A-Z-]+ ([0-9]+)", 1)],
}
CATEGORY_LEXICON = {
    "AI Infrastructure": {"that": 2, "und": 2, "que": 1},
    "AI Products & Services": {"with": 2, "for": 1, "die": 1, "les": 2},
    "AI Partnerships": {"and": 1, "et": 2, "los": 2},
}
TONE_LEXICON = {
    "Positive": {"is": 2, "ist": 2, "est": 1},
    "Cautious": {"this": 2, "nicht": 3, "pour": 2},
    "Negative": {"was": 3, "von": 1, "por": 2},
}
POSITIVE = ["the", "der", "la", "with"]
NEGATIVE = ["of", "von", "de", "was"]
# a word is tried from its first letter only, which keeps the scan linear
# spellings under which the invented prose names a company as a subject
SUBJECT_NAMES = {
    "Amazon.com, Inc.": ["the", "der"],
    "Apple Inc.": ["that", "die"],
    "Meta Platforms, Inc.": ["les", "los"],
    "Microsoft Corporation": ["this", "und"],
    "NVIDIA Corporation": ["with", "que"],
}
_FIRST, _SECOND = r"(?:^|[^\p{L}])(\p{L}{3,})", r"(\p{L}{3,})"
TRIPLET_PATTERNS = [
    ("partners_with", rf"{_FIRST} with {_SECOND}", "Company", "Company"),
    ("competes_with", rf"{_FIRST} or {_SECOND}", "Company", "Company"),
    ("invests_in", rf"{_FIRST} for {_SECOND}", "Company", "Market"),
    ("acquires", rf"{_FIRST} by {_SECOND}", "Company", "Product"),
    ("uses_technology", rf"{_FIRST} from {_SECOND}", "Company", "Technology"),
    ("supplies_to", rf"{_FIRST} to {_SECOND}", "Company", "Company"),
    ("mentions", rf"{_FIRST} and {_SECOND}", "Person", "Product"),
]
#: What stands between the two words of a hit; a full stop can only be the character in front of it.
TRIPLET_WORDS = {
    "partners_with": " with ", "competes_with": " or ", "invests_in": " for ", "acquires": " by ",
    "uses_technology": " from ", "supplies_to": " to ", "mentions": " and ",
}
# ---------------------------------------------------------------------------

SUBJECT_ALIASES = {alias: company for company, aliases in SUBJECT_NAMES.items() for alias in aliases}
ALIASES = {alias: company for company, aliases in COMPANY_OF_SOURCE.items() for alias in aliases}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of rows in a shuffle for each byte of the driver tables' files, about what the triples of the star schema take.
SHUFFLE_GROWTH = 16


def shuffle_bytes(spark: SparkSession, sf_dir: str) -> int:
    """The largest shuffle to expect over the driver tables in a folder, by the size of their files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return SHUFFLE_GROWTH * files.getContentSummary(folder).getLength()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out when a scan has fewer splits than the cluster has slots.

    A corpus that already splits into enough tasks is left alone; a small file
    would otherwise parse on one core.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots, *keys) if df.rdd.getNumPartitions() < slots else df


def raw_path(folder: Column, name: Column) -> Column:
    return F.concat(F.lit(f"/corpus/{V.RAW_ROOT}/"), folder, F.lit("/"), name, F.lit(".txt"))


def document_files(docs: DataFrame) -> DataFrame:
    return docs.select(
        raw_path(F.col("lang"), F.concat_ws("_", "source", F.col("doc_id").cast("string"))).alias("source_path"), "text"
    )


def call_files(conversations: DataFrame) -> DataFrame:
    turn = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return conversations.select(raw_path(F.lit("Earnings Call"), F.concat_ws("_", "role", turn)).alias("source_path"), "text")


_MODELS: dict[tuple[str, str], str] = {}


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Documents that no model learns from."""
    return F.md5(F.col(doc_id).cast("string")).substr(1, 1) <= "2"


def quality_model(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the quality classifier, fitted and saved on first use."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _MODELS:
        docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
        labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").where(~held_out())
        _MODELS[key] = f"{scratch_folder(spark)}/quality-model-{uuid.uuid4().hex}"
        C.save_classifier(C.train_classifier(labelled, "text", "quality"), _MODELS[key])
    return _MODELS[key]


_FILES: dict[tuple[str, str], str] = {}


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file for every document, written by Spark's tasks on first use: its text and a line feed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _FILES:
        _FILES[key] = f"{scratch_folder(spark)}/text-files-{uuid.uuid4().hex}"
        docs = spread(table(spark, sf_dir, "documents").select("text"), "text")
        write_text_files(docs, _FILES[key])
    return _FILES[key]


def write_text_files(texts: DataFrame, folder: str) -> int:
    """Write a file for every row (column ``text``) and return how many.

    A task writes its files into a folder of its attempt, which gets its name when it is whole: one that runs again leaves
    no second copy. Spark's writer makes one file at a time as well, but spends 13 ms on each in permissions and commits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        draft, whole = f"{root}/_draft-{task.taskAttemptId()}", f"{root}/part-{task.partitionId():05d}"
        written = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                at = f"{draft}/{written // 1000:05d}"
                if written % 1000 == 0:
                    files.create_dir(at)
                with files.open_output_stream(f"{at}/{written:08d}.txt") as out:
                    out.write(f"{text or ''}\n".encode())
                written += 1
        if written and files.get_file_info(whole).type == pafs.FileType.NotFound:
            files.move(draft, whole)
        yield pa.RecordBatch.from_arrays([pa.array([written], pa.int64())], names=["n"])

    return texts.select("text").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def as_bronze(files: DataFrame) -> DataFrame:
    return files.select(
        "source_path",
        F.encode("text", "UTF-8").alias("content"),
        F.octet_length("text").cast("bigint").alias("file_size_bytes"),
        F.current_timestamp().alias("ingested_at"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and conversation turns as files."""
    docs = spread(document_files(table(spark, sf_dir, "documents")), "source_path")
    return as_bronze(docs.unionByName(spread(call_files(table(spark, sf_dir, "conversations")), "source_path")))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver before expectations."""
    return M.silver_rows(bronze(spark, sf_dir), fmt="text", rules=FIELD_RULES, aliases=ALIASES)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.silver(bronze(spark, sf_dir), fmt="text", rules=FIELD_RULES, aliases=ALIASES)


def gold(silver_table: DataFrame) -> DataFrame:
    return M.gold(
        silver_table,
        lambda words: C.ai_investment_category(words, CATEGORY_LEXICON),
        lambda words: C.management_sentiment(words, TONE_LEXICON),
    )


# ------------------------------------------------- stored once per session ----
_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, written on first use and scanned afterwards."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _STORED:
        built = _BUILDERS[name](spark, sf_dir)
        _STORED[key] = built if name in _STORED_ALREADY else materialize(built, name)
    return _STORED[key]


_INDEXES: dict[tuple[str, str, str], PX.StoredIndex] = {}


def stored_index(spark: SparkSession, sf_dir: str, name: str) -> PX.StoredIndex:
    """The search index of ``chunks`` or of whole ``documents``, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _INDEXES:
        path = f"{scratch_folder(spark)}/{name}-index-{uuid.uuid4().hex}"
        if name == "documents":
            rows, about = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id"), {"key": "doc_id", "text": "text", "embedded": None}
        else:
            rows, about = stored(spark, sf_dir, "chunks"), {}
        _INDEXES[key] = PX.write_index(rows, path, **about)
    return _INDEXES[key]


_GRAPHS: dict[tuple[str, str], str] = {}


def stored_graph(spark: SparkSession, sf_dir: str) -> str:
    """Name of the stored graph of the star schema's triples, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _GRAPHS:
        _GRAPHS[key] = f"docloom_graph_{uuid.uuid4().hex}"
        G.write_graph(stored(spark, sf_dir, "relationships"), _GRAPHS[key], buckets=16)
    return _GRAPHS[key]


def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search table: the index's chunks with the vector of the enriched text and the tokens of the raw one."""
    return stored_index(spark, sf_dir, "chunks").chunks.drop("n_tokens", "content_hash", "no", "bucket")


def _triplets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(spark, sf_dir, "silver").drop("parsed_document")
    return X.extract_triplets(rows, "plain_text", TRIPLET_PATTERNS, words=TRIPLET_WORDS)


#: Rows of a table that a join may gather in the driver and send to every task.
BROADCAST_ROWS = 250_000


def join_side(df: DataFrame) -> DataFrame:
    """A table to join with: one of many rows isn't broadcast, however small its files are."""
    return df.hint("merge") if df.count() > BROADCAST_ROWS else df  # counted in the files' footers


def star_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line, part, supplier, customer and page link as a triple."""
    t = {n: table(spark, sf_dir, n) for n in "region nation customer supplier part orders lineitem pages".split()}
    product = F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))

    def triple(df: DataFrame, company: Column, period: Column, subject: Column, predicate: str, obj: Column) -> DataFrame:
        return df.select(
            company.alias("company"), period.alias("fiscal_period"), subject.alias("subject"),
            F.lit(predicate).alias("predicate"), obj.alias("object"),
        )

    def year(column: str) -> Column:
        return F.concat(F.lit("FY"), F.year(column).cast("string"))

    catalog, always = F.lit("catalog"), F.lit("FY")
    based = t["supplier"].join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    # order lines, the most rows, are shuffled for their orders and suppliers once these are joined, and then for their parts
    made = join_side(t["part"])
    ordered = t["orders"].join(join_side(t["customer"]), F.col("o_custkey") == F.col("c_custkey"))
    supplied = (
        t["lineitem"].select("l_suppkey", "l_partkey", "l_shipdate")
        .join(based, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(made, F.col("l_partkey") == F.col("p_partkey"))
    )
    bought = (
        t["lineitem"].select("l_orderkey", "l_partkey")
        .join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(made, F.col("l_partkey") == F.col("p_partkey"))
    )
    placed = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    linked = t["pages"].select(
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), 1)).alias("href"),
    )
    parts = [
        triple(supplied, F.col("n_name"), year("l_shipdate"), F.col("s_name"), "supplies_to", product),
        triple(bought, F.col("c_mktsegment"), year("o_orderdate"), F.col("c_name"), "acquires", product),
        triple(t["part"], catalog, always, product, "uses_technology", F.col("p_brand")),
        triple(t["customer"], catalog, always, F.col("c_name"), "invests_in", F.col("c_mktsegment")),
        triple(based, catalog, always, F.col("s_name"), "partners_with", F.col("n_name")),
        triple(placed, catalog, always, F.col("n_name"), "partners_with", F.col("r_name")),
        triple(linked, catalog, always, F.col("host"), "mentions", F.col("href")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def star_entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named things of the star schema; page hosts and links are left to the back-fill."""
    t = {n: table(spark, sf_dir, n) for n in "region nation customer supplier part".split()}

    def entity(name: Column, kind: str, description: Column, source: str) -> DataFrame:
        return t[source].select(
            F.lit("catalog").alias("company"), F.lit("FY").alias("fiscal_period"), name.alias("entity_name"),
            F.lit(kind).alias("entity_type"), description.alias("description"),
        )

    title = F.concat(F.when(F.col("c_acctbal") > 5000, "Chief buyer, ").otherwise("Buyer, "), F.col("c_mktsegment"))
    parts = [
        entity(F.col("s_name"), "Company", F.lit("Supplier"), "supplier"),
        entity(F.col("c_name"), "Person", title, "customer"),
        entity(F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")), "Product", F.col("p_type"), "part"),
        entity(F.col("p_brand"), "Technology", F.concat(F.lit("Brand, size "), F.col("p_size").cast("string")), "part"),
        entity(F.col("p_brand"), "Product", F.lit("Brand range"), "part"),
        entity(F.col("c_mktsegment"), "Market", F.lit("Segment"), "customer"),
        entity(F.col("n_name"), "Market", F.lit("Nation"), "nation"),
        entity(F.col("r_name"), "Market", F.lit("Region"), "region"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.build_entities(star_entity_mentions(spark, sf_dir))


def _all_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.entities_with_backfill(stored(spark, sf_dir, "entities"), stored(spark, sf_dir, "relationships"))


def _text_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.build_relationships(X.relationship_mentions(X.parse_structured(stored(spark, sf_dir, "triplets_raw"))))


_BUILDERS = {
    "silver": silver,
    "gold": lambda spark, d: gold(stored(spark, d, "silver")),
    "summary": lambda spark, d: S.investment_summary(stored(spark, d, "gold")),
    "chunks": lambda spark, d: M.chunks(stored(spark, d, "silver")),
    "search": _search,
    "triplets_raw": _triplets_raw,
    "relationships": lambda spark, d: G.build_relationships(star_mentions(spark, d)),
    "entities": _entities,
    "all_entities": _all_entities,
    "text_relationships": _text_relationships,
}

#: Builders that return a scan of what they wrote.
_STORED_ALREADY = {"search"}

BUILD_ORDER = list(_BUILDERS)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as questions with vectors; some name the companies they are about."""
    size = F.length("text")
    companies = (
        F.when(size > 250, F.array(F.lit("NVIDIA Corporation")))
        .when(size > 200, F.array(F.lit("Apple Inc."), F.lit("Meta Platforms, Inc.")))
    )
    rows = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("question"), companies.alias("companies")
    )
    return embed_text(rows, "question")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as job runs: start and end in epoch milliseconds, some unfinished."""
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        start.alias("start_time"),
        F.when(F.col("event_type") != "view", start + F.floor(F.col("value") * 1000)).alias("end_time"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "purchase", "SUCCESS").alias("result_state"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a pipeline's log with JSON details."""
    k = F.get_json_object("props", "$.k")
    quality = F.concat(
        F.lit('{"flow_progress":{"data_quality":{"dropped_records":'), k, F.lit(',"warned_records":'),
        F.col("user_id").cast("string"),
        F.when(F.col("event_type") == "error", "").otherwise(F.concat(F.lit(',"expectations":"'), F.col("event_type"), F.lit('"'))),
        F.lit("}}}"),
    )
    kind = F.when(F.col("event_type") == "signup", "update_progress").otherwise("flow_progress")
    return table(spark, sf_dir, "events").select(F.col("ts").alias("timestamp"), kind.alias("event_type"), quality.alias("details"))
