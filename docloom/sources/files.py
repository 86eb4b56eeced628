"""Document files as rows: one-shot, incremental, and counted.

Folders are listed by tasks, level by level, and files are read by tasks: the driver, which a listing
by Spark's own source fills with an entry for each file, holds none of their names.
"""

from __future__ import annotations

import math
import re
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import materialize, scratch_folder

# A file stream must be told its schema; this is the binary source's own.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: A listed file: its path below the root, quoted as in a Java URI, and its size.
LISTED = "path string, length bigint"
#: Tasks that list folders at most, files that a task reads about, and bytes of contents that it holds at once.
LISTING_TASKS, FILES_A_TASK, READ_BYTES = 64, 10_000, 16 << 20
#: Files of a manifest where a stream isn't told how many a batch has.
MANIFEST_FILES = 10_000


def with_provenance(df: DataFrame, path: Column | None = None) -> DataFrame:
    """Add where a row came from and when it was read."""
    return df.withColumns(
        {"source_path": F.col("_metadata.file_path") if path is None else path, "ingested_at": F.current_timestamp()}
    )


def _root(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """A file or folder as Spark names it in its rows, and as pyarrow opens it; None for what only Spark's reader can open."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):  # a pattern, or missing
        return None
    uri = files.makeQualified(at).toUri()
    host = f"//{uri.getAuthority()}" if uri.getAuthority() else ""
    named = f"{uri.getScheme()}:{host}{_quoted(uri.getPath())}"
    opened = f"{uri.getScheme()}://{uri.getAuthority() or ''}{urllib.parse.quote(uri.getPath())}"
    try:
        seen = pafs.FileSystem.from_uri(opened)
        known = seen[0].get_file_info(seen[1]).type != pafs.FileType.NotFound
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return (named, opened) if known else None


def _passed_over(name: str) -> bool:
    """Names that Spark's readers pass over."""
    kept = name.startswith(("_common_metadata", "_metadata"))
    return not kept and ((name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_"))


def _quoted(path: str) -> str:
    """A path as Java quotes it in a URI, which is how Spark gives paths."""
    return re.sub(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=@/\u00a1-\U0010ffff]|\s", lambda c: urllib.parse.quote(c[0], safe=""), path)


def listed(spark: SparkSession, opened: str, glob: str | None = None) -> DataFrame:
    """``LISTED`` rows of all files below a root that aren't empty, which Spark's reader leaves out; each round of tasks lists a level of folders and stores it."""
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern() if glob else None
    passed_over, quoted = _passed_over, _quoted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(opened)
        wanted = re.compile(pattern, re.DOTALL) if pattern else None
        for batch in batches:
            for below in map(urllib.parse.unquote, batch.column(0).to_pylist()):
                about = files.get_file_info(root + below)
                inside = [about] if about.is_file else files.get_file_info(pafs.FileSelector(root + below))
                folders = [i.type == pafs.FileType.Directory for i in inside]
                asked = [folder or (i.size and (not wanted or wanted.fullmatch(i.base_name))) for folder, i in zip(folders, inside, strict=True)]
                kept = [k for k, i in enumerate(inside) if asked[k] and (i.path == root or not passed_over(i.base_name))]
                for start in range(0, len(kept), 10_000):
                    some = kept[start : start + 10_000]
                    columns = [pa.array([quoted(inside[k].path[len(root) :]) for k in some], pa.string()), pa.array([inside[k].size or 0 for k in some], pa.int64()),
                               pa.array([folders[k] for k in some], pa.bool_())]
                    yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "folder"])

    schema = f"{LISTED}, folder boolean"
    at, levels = f"{scratch_folder(spark)}/listing-{uuid.uuid4().hex}", []
    folders, number = spark.createDataFrame([("",)], "path string"), 1
    while number:
        levels.append(f"{at}/{len(levels)}")
        folders.repartition(min(number, LISTING_TASKS)).mapInArrow(run, schema).write.parquet(levels[-1])
        folders = spark.read.schema(schema).parquet(levels[-1]).where("folder").select("path")
        number = folders.count()
    return spark.read.schema(schema).parquet(*levels).where("NOT folder").select("path", "length")


def _contents(opened: str):
    """A function of paths below the root that gives the files' bytes, ``READ_BYTES`` or one file at a time."""
    most = READ_BYTES

    def read(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        files, root = pafs.FileSystem.from_uri(opened)
        for some in paths:
            held, size = [], 0
            for path in map(urllib.parse.unquote, some.to_pylist()):
                with files.open_input_file(root + path) as file:
                    held.append(file.readall())
                size += len(held[-1])
                if size >= most:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    return F.arrow_udf(read, "binary").asNondeterministic()


def _read(files: DataFrame, named: str, opened: str) -> DataFrame:
    """Bronze rows of listed files; contents that nobody asks for aren't read."""
    rows = files.withColumns({"content": _contents(opened)("path"), "path": F.concat(F.lit(named), "path")})
    return _bronze(rows, F.col("path"))


def _bronze(files: DataFrame, path: Column | None = None) -> DataFrame:
    return with_provenance(files, path).select(
        "source_path", "content", F.col("length").alias("file_size_bytes"), "ingested_at"
    )


def ingest_batch(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """All files below ``path``: source_path, content, file_size_bytes, ingested_at.

    A path with patterns, and one that pyarrow can't open, is listed by Spark's reader and so in the driver.
    """
    if (root := _root(spark, path)) is not None:
        files = listed(spark, root[1], glob)
        number, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(number / FILES_A_TASK), math.ceil(size / (128 << 20)))
        return _read(files.repartition(tasks, "path"), *root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _bronze(reader.load(path))


def new_manifests(spark: SparkSession, opened: str, glob: str | None, manifests: str, files_a_manifest: int) -> int:
    """Name the files that no manifest names yet in new ones, and return how many they are. One call at a time."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(manifests)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    # paths take far less in files than in memory, so the known ones aren't broadcast
    known = spark.read.schema(LISTED).parquet(manifests).select("path").hint("merge")
    new = materialize(listed(spark, opened, glob).join(known, "path", "left_anti"), "new-files")
    if number := new.count():
        dealt = new.repartition(math.ceil(number / files_a_manifest))
        dealt.write.mode("append").option("maxRecordsPerFile", files_a_manifest).parquet(manifests)
    return number


def ingest_stream(spark: SparkSession, path: str, glob: str | None = "*.pdf", files_per_batch: int | None = None,
                  manifests: str | None = None) -> DataFrame:
    """The same rows as a stream that delivers each file once per checkpoint.

    With ``manifests``, a folder that belongs to the files and outlives the checkpoints, each call lists the files in
    tasks and names new ones there, and the stream is one of manifests: the driver remembers these, not every
    file. Without it, Spark's source remembers every file in the driver, which suits some hundred thousand.
    """
    if manifests and (root := _root(spark, path)) is not None:
        new_manifests(spark, root[1], glob, manifests, files_per_batch or MANIFEST_FILES)
        reader = spark.readStream.schema(LISTED)
        named = (reader.option("maxFilesPerTrigger", 1) if files_per_batch else reader).parquet(manifests)
        return _read(named.repartition(spark.sparkContext.defaultParallelism, "path"), *root)
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _bronze(reader.load(path))


def folder_of(path: Column | str) -> Column:
    """Name of the folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def corpus_inventory(files: DataFrame, path: str = "source_path", size: str = "file_size_bytes", minimum: int = 50) -> DataFrame:
    """Files and megabytes per folder plus the total, flagged when below ``minimum`` files.

    Reads names and sizes only; file contents are pruned from the scan.
    """
    per_folder = files.groupBy(folder_of(path).alias("folder")).agg(
        F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes")
    )
    rolled = per_folder.rollup("folder").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"),
                                             F.grouping("folder").alias("_total"))
    return rolled.select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("folder")).alias("folder"),
        "files",
        F.round(F.col("bytes") / 1e6, 6).alias("megabytes"),
        ((F.col("_total") == 1) & (F.col("files") < minimum)).alias("below_minimum"),
    )
