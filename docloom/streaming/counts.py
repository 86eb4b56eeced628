"""Counts by key of a changing table, kept up by its batches instead of being counted anew.

Each batch leaves one folder of signed counts, named by the batch's number: a batch that is
delivered again writes the same folder again, so it adds nothing. Every ``compact`` batches
the folders are added up into a new base, named by the last batch in it; batches up to the
base are known and are not counted again. A base counts once its folder is complete, and
only then do the folders that it holds go, so a run that dies between two steps loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: The column that says how often a row counts: 1 for a new one, -1 for one that is gone.
SIGN = "_sign"


class CountView:
    """``count`` of rows by ``keys``; NULL is a key like any other."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], count: str = "document_count", compact: int = 16) -> None:
        self.spark, self.path, self.keys, self.count, self.compact = spark, path.rstrip("/"), keys, count, compact

    def _numbers(self, kind: str) -> list[int]:
        """Numbers of the complete folders of a kind, in order."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        root = hadoop.Path(f"{self.path}/{kind}")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        folders = [status.getPath() for status in files.listStatus(root)]
        return sorted(int(f.getName()) for f in folders if files.exists(hadoop.Path(f, "_SUCCESS")))

    def _delete(self, kind: str, number: int) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{number}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _summed(self, parts: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*parts)
        return rows.groupBy(*self.keys).agg(F.sum(self.count).alias(self.count)).where(F.col(self.count) != 0)

    def _parts(self) -> tuple[int, list[int], list[str]]:
        """The base's number (-1: none), the numbers of later batches, and the folders of all of them."""
        bases = self._numbers("base")
        base = bases[-1] if bases else -1
        later = [n for n in self._numbers("batch") if n > base]
        return base, later, [f"{self.path}/base/{base}"] * bool(bases) + [f"{self.path}/batch/{n}" for n in later]

    def apply(self, rows: DataFrame, batch_id: int) -> None:
        """Count a batch's rows; those with a ``_sign`` of -1 are taken away."""
        base, later, _ = self._parts()
        if batch_id <= base:
            return
        sign: Column = F.col(SIGN) if SIGN in rows.columns else F.lit(1)
        counted = rows.groupBy(*self.keys).agg(F.sum(sign.cast("long")).alias(self.count)).where(F.col(self.count) != 0)
        counted.write.mode("overwrite").parquet(f"{self.path}/batch/{batch_id}")
        if len({*later, batch_id}) >= self.compact:
            self.fold()

    def fold(self) -> None:
        """Add all batches up into a new base."""
        base, later, parts = self._parts()
        if later:
            self._summed(parts).write.mode("overwrite").parquet(f"{self.path}/base/{later[-1]}")
            for number in later:
                self._delete("batch", number)
            if base >= 0:
                self._delete("base", base)

    def read(self) -> DataFrame:
        """The counts now: the base and what came after it."""
        parts = self._parts()[2]
        if not parts:
            raise ValueError(f"no batch has come to {self.path}")
        return self._summed(parts)


def signed(before: DataFrame, after: DataFrame, changes: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Rows of a change set with their signs: old versions that go, new versions that come."""
    gone = before.join(changes.where(F.col("change").isin("delete", "update")).select(key), key, "left_semi").select(*before.columns, F.lit(-1).alias(SIGN))
    come = after.join(changes.where(F.col("change").isin("insert", "update")).select(key), key, "left_semi").select(*before.columns, F.lit(1).alias(SIGN))
    return gone.unionByName(come)


def count_stream(rows: DataFrame, view: CountView, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Take everything a stream has now into a view, then stop; ``prepare`` maps each batch first."""
    writer = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(lambda batch, batch_id: view.apply(prepare(batch), batch_id)).start()
    query.awaitTermination()
    return query
