"""Reading, writing and declaring tables; change sets between table versions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.session import materialize


def read_table(spark: SparkSession, name: str, *columns: str) -> DataFrame:
    """Batch scan of a table, or of a parquet path when the name has a slash."""
    df = spark.read.parquet(name) if "/" in name else spark.read.table(name)
    return df.select(*columns) if columns else df


def read_stream_table(spark: SparkSession, name: str) -> DataFrame:
    """Stream over a table's appends; a parquet path takes its present schema."""
    if "/" in name:
        return spark.readStream.schema(spark.read.parquet(name).schema).parquet(name)
    return spark.readStream.table(name)


def overwrite_table(df: DataFrame, name: str, balanced: bool = True) -> DataFrame:
    """Replace a table's rows and schema and return a scan of the new one.

    ``balanced`` lets adaptive execution even out the output files.
    """
    out = df.hint("rebalance") if balanced else df
    out.write.mode("overwrite").option("overwriteSchema", "true").format("parquet").saveAsTable(name)
    return df.sparkSession.read.table(name)


def append_by_name(df: DataFrame, name: str) -> None:
    """Append rows matched to the table's columns by name, whatever their order."""
    target = df.sparkSession.read.table(name)
    extra = sorted(set(df.columns) ^ set(target.columns))
    if extra:
        raise ValueError(f"columns differ from {name}: {extra}")
    df.select(*target.columns).write.mode("append").insertInto(name)


def append_positional(base: DataFrame, extra: DataFrame) -> DataFrame:
    """The appended relation as a DataFrame: columns are matched by name."""
    return base.unionByName(extra)


def streaming_table(df: DataFrame, name: str, checkpoint: str,
                    properties: dict[str, str] | None = None, comment: str | None = None) -> StreamingQuery:
    """Append everything a stream has now to a table (or a parquet path), then stop.

    The folder ``checkpoint`` remembers what was delivered: a rerun with the same
    one adds new input only.
    """
    spark = df.sparkSession
    is_path = "/" in name
    writer = (
        df.writeStream.outputMode("append").trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).format("parquet")
    )
    query = writer.start(name) if is_path else writer.toTable(name)
    query.awaitTermination()
    if not is_path:
        _describe(spark, name, properties, comment)
    return query


def materialized_view(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                      properties: dict[str, str] | None = None, comment: str | None = None) -> DataFrame:
    """Recompute a table from its definition."""
    view = overwrite_table(build(), name)
    _describe(spark, name, properties, comment)
    return view


def _describe(spark: SparkSession, name: str, properties: dict[str, str] | None, comment: str | None) -> None:
    entries = {**(properties or {}), **({"comment": comment} if comment else {})}
    if entries:
        quoted = ", ".join(f"'{_quote(k)}' = '{_quote(v)}'" for k, v in sorted(entries.items()))
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({quoted})")


def _quote(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


# ------------------------------------------------------------- change sets ----
def content_hash(df: DataFrame, key: str) -> Column:
    """A digest of all columns but the key."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns) if c != key]
    return F.sha2(F.concat_ws("\1", *values), 256)


def chunk_changes(old: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``(key, change)`` with insert / update / delete / same.

    Only keys and content hashes are shuffled; texts stay where they are.
    """
    before = old.select(key, content_hash(old, key).alias("_old"))
    after = new.select(key, content_hash(new, key).alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") == F.col("_new"), "same")
        .otherwise("update")
    )
    return before.join(after, key, "full_outer").select(key, change.alias("change"))


def apply_changes(old: DataFrame, new: DataFrame, changes: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The synced table: untouched old rows plus inserted and updated new rows."""
    gone = changes.where(F.col("change").isin("delete", "update")).select(key)
    come = changes.where(F.col("change").isin("insert", "update")).select(key)
    return old.join(gone, key, "left_anti").unionByName(new.join(come, key, "left_semi"))


# ------------------------------------------------------- bucketed tables ----
def bucket_of(key: Column | str, buckets: int) -> Column:
    """The bucket of a key: the partition of a bucketed table that holds it."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, touched: list[int] | None = None, held: DataFrame | None = None) -> None:
    """Write rows with their ``bucket`` as a folder partitioned by it.

    With ``touched``, ``df`` holds these buckets' rows: only their partitions are replaced,
    and those that have no rows any more go. ``held`` names the same buckets as ``df``, where it is cheaper to read.
    """
    mode = "static" if touched is None else "dynamic"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("bucket").parquet(path)
    if touched:
        filled = {r["bucket"] for r in (df if held is None else held).select("bucket").distinct().collect()}  # numbers of buckets
        for bucket in set(touched) - filled:
            folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={bucket}")
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def move_buckets(spark: SparkSession, staged: str, path: str, touched: list[int]) -> None:
    """Replace the touched buckets of ``path`` by those of a folder on the same file system, which goes; those without rows go too."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    files = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for bucket in touched:
        new, old = at(f"{staged}/bucket={bucket}"), at(f"{path}/bucket={bucket}")
        files.delete(old, True)
        if files.exists(new) and not files.rename(new, old):
            raise OSError(f"{new} was not moved to {old}")
    files.delete(at(staged), True)


def touched_buckets(changes: DataFrame, key: str, buckets: int) -> list[int]:
    """Numbers of the buckets that hold a changed key."""
    moved = changes.where(F.col("change") != "same").select(bucket_of(key, buckets).alias("bucket"))
    return [r["bucket"] for r in moved.distinct().collect()]


def write_bucketed(df: DataFrame, path: str, key: str = "chunk_id", buckets: int = 64) -> None:
    """A keyed table in buckets of its key, for ``apply_bucketed``."""
    write_buckets(df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket"), path)


def apply_bucketed(spark: SparkSession, path: str, new: DataFrame, changes: DataFrame, key: str = "chunk_id", buckets: int = 64) -> DataFrame:
    """Apply a change set to a table that ``write_bucketed`` wrote: only the buckets of changed keys are read and rewritten."""
    touched = touched_buckets(changes, key, buckets)
    if touched:
        stored = spark.read.parquet(path)
        columns = [c for c in stored.columns if c != "bucket"]
        rows = apply_changes(stored.where(F.col("bucket").isin(touched)).select(*columns), new.select(*columns), changes, key)
        rows = materialize(rows.withColumn("bucket", bucket_of(key, buckets)), "buckets")  # read from the folder it goes to
        write_buckets(rows.repartition("bucket"), path, touched)
    return spark.read.parquet(path).drop("bucket")
