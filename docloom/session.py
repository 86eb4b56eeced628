"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that belong to the job, not to the machine it runs on.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # as compressed: rows of names take some ten times that in a task's memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # bounds the whole texts that one Python worker holds at once
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # stored texts are written and read several times
    "spark.sql.parquet.compression.codec": "zstd",
    # thousands of files are listed by some tasks, not by a task each
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # a list of words asked for reaches the scan as such, not as the range it spans
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # A union that claims its inputs' partitioning breaks once adaptive execution
    # coalesces those inputs differently ("can't zip RDDs").
    "spark.sql.unionOutputPartitioning": "false",
}


SHUFFLE_PARTITION_BYTES = 128 << 20


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the job's settings to a session someone else made.

    ``shuffle_bytes``, the size of the largest shuffle expected, raises the
    number of shuffle partitions until each fits a task's memory; adaptive
    execution merges them again where a shuffle turns out smaller.
    """
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        wanted = math.ceil(shuffle_bytes / SHUFFLE_PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark


def local_session(cpus: int | str = "*", app: str = "docloom", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**JOB_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local folder would vanish with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage at a table that outlives lost executors, so a costly or
    order-dependent column is computed once however often it is read.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/docloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete what ``materialize`` stored for this application; call it when nothing reads it any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
