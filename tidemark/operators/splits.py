"""Splits, buckets and progress figures."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.encode import megabytes


def bucket_of(c: Column) -> Column:
    """Splits without a bucket belong to bucket 0."""
    return F.coalesce(c, F.lit(0))


def ordered_splits(splits: DataFrame, bucket: str = "_bucket", snapshot: str = "_snapshot_id", sequence: str = "_min_seq", split: str = "split_id") -> DataFrame:
    """Splits with their place in their bucket: by snapshot, then by least sequence number (0 where there is none), then by name."""
    from pyspark.sql import Window as W

    order = W.partitionBy("_b").orderBy(snapshot, F.coalesce(sequence, F.lit(0)), split)
    return splits.withColumn("_b", bucket_of(F.col(bucket))).withColumn("place", F.row_number().over(order)).withColumn(bucket, F.col("_b")).drop("_b")


def in_bucket_order(rows: DataFrame, bucket: str = "_bucket", order: Iterable[str] = ("_snapshot_id", "_seq")) -> DataFrame:
    """Rows dealt to partitions by bucket and sorted there, for writers that must see them one after another."""
    return rows.repartition(bucket_of(F.col(bucket))).sortWithinPartitions(bucket_of(F.col(bucket)), *order)


def bucket_sizes(splits: DataFrame, bucket: str = "_bucket", size: str = "file_size") -> DataFrame:
    """Bytes and MB of each bucket, and of all together (bucket null)."""
    return splits.withColumn(bucket, bucket_of(F.col(bucket))).rollup(bucket).agg(F.sum(size).alias("bytes")).withColumn("mb", megabytes(F.col("bytes")))


def bucket_stats(splits: DataFrame, bucket: str = "_bucket", size: str = "file_size", rows: str = "row_count") -> DataFrame:
    """Bytes, rows and number of splits of each bucket."""
    return splits.groupBy(bucket_of(F.col(bucket)).alias(bucket)).agg(F.sum(size).alias("bytes"), F.sum(rows).alias("rows"), F.count("*").alias("splits"))


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def throughput(batches: DataFrame, docs: str = "docs", ms: str = "ms") -> DataFrame:
    """Totals of batches and what they come to: documents a second, documents and milliseconds a batch."""
    sums = batches.agg(F.sum(docs).alias("docs"), F.count("*").alias("batches"), F.sum(ms).alias("ms"))
    return sums.select(
        "docs", "batches", "ms",
        ratio(F.col("docs") * 1000.0, F.col("ms")).alias("docs_per_sec"),
        ratio(F.col("docs") * 1.0, F.col("batches")).alias("docs_per_batch"),
        ratio(F.col("ms") * 1.0, F.col("batches")).alias("ms_per_batch"),
    )


@dataclass
class Progress:
    """Running totals of a runner, and which buckets of a batch are still open."""

    docs: int = 0
    batches: int = 0
    ms: int = 0
    pending: set[int] = field(default_factory=set)
    completed: set[int] = field(default_factory=set)

    def begin(self, buckets: Iterable[int]) -> None:
        self.pending, self.completed = set(buckets), set()

    def complete(self, bucket: int) -> bool:
        """Whether this completed an open bucket; a second time, and for others, it doesn't."""
        if bucket not in self.pending:
            return False
        self.pending.remove(bucket)
        self.completed.add(bucket)
        return True

    @property
    def remaining(self) -> int:
        return len(self.pending)

    def add(self, docs: int, ms: int) -> float:
        """Counts a batch; returns its documents a second."""
        self.docs, self.batches, self.ms = self.docs + docs, self.batches + 1, self.ms + ms
        return docs * 1000 / ms if ms > 0 else 0.0

    def summary(self) -> dict[str, float] | None:
        """Averages over all batches, once there is something to average."""
        if not self.docs or not self.ms:
            return None
        return {"docs_per_sec": self.docs * 1000 / self.ms, "docs_per_batch": self.docs / self.batches, "ms_per_batch": self.ms / self.batches}
