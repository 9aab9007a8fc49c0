"""What the operators of this package share: word splitting, shared storage, row order."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import fresh_path, remove, saved, shared_dir, table

__all__ = ["fresh_path", "remove", "saved", "shared_dir", "table"]

#: Java and Python pattern of one word, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: DuckDB's expression for the words of ``text``.
SQL_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

#: Bytes that are no part of a word become blanks, A-Z become a-z; bytes of other code points stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased; none for None."""
    return text.translate(_FOLD).split() if text else []


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z and nothing else; lower() would also fold letters outside ASCII."""
    return F.translate(c, UPPER, LOWER)


#: Rows that a side may have to be broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def narrow(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side marked for broadcast if it is short, else as it is. Counting it should cost little: save it first."""
    return F.broadcast(side) if side.count() <= most else side


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    return df[name].cast(kind) if name in df.columns else F.lit(None).cast(kind)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_cuts(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most parts - 1 values of an integer column that cut its rows into ranges of about equal size; reads that column only."""
    if parts < 2:
        return []
    qs = df.select(F.percentile_approx(key, [i / parts for i in range(1, parts)], min(100 * parts, 1_000_000)).alias("q")).first()["q"]
    return sorted({int(q) for q in qs or []})


def range_number(c: Column, cuts: list[int]) -> Column:
    """0 for values below the first cut (and null), i for those from the i-th cut on; found by halving, so many cuts cost little."""
    if not cuts:
        return F.lit(0)
    array = F.from_json(F.lit("[" + ",".join(map(str, cuts)) + "]"), T.ArrayType(T.LongType()))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda low, step: F.when(F.get(array, low + step - 1) <= c, low + step).otherwise(low))
    return F.when(c.isNull(), F.lit(0)).otherwise(at)


def by_id_ranges(df: DataFrame, key: str, parts: int, cuts: list[int]) -> DataFrame:
    """Rows dealt to partition i when their key is in range i; adds that number as _part."""
    return df.withColumn("_part", range_number(F.col(key), cuts)).repartitionById(max(1, min(parts, len(cuts) + 1)), F.col("_part"))


BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows with texts that a Python worker gets at a time. With Spark's 10,000 a batch of ordinary texts takes tens of MB, in the JVM and in Python.
TEXT_ROWS, TEXT_BYTES = 500, 4 << 20


def text_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> SparkSession:
    """From now on this session's Python workers get so many rows, and TEXT_BYTES, at a time: for what others write, as the pipeline's stages."""
    spark.conf.set(BATCH, rows)
    spark.conf.set(BATCH_BYTES, TEXT_BYTES)
    return spark


def tidy(walk: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``walk`` for mapInArrow, after which a worker gives memory back: the same process serves other tasks and stages later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from walk(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return run


@contextmanager
def small_batches(spark: SparkSession, rows: int = TEXT_ROWS):
    """While actions run here, Python workers get so many rows, and TEXT_BYTES, at a time: long texts need memory."""
    old = {k: spark.conf.get(k) for k in (BATCH, BATCH_BYTES)}
    text_batches(spark, rows)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
