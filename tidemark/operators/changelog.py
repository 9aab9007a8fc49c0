"""Changelogs: row kinds, the net state per key, and the batches that a sequential writer would send.

Rows carry ``_row_kind`` (``+I``, ``-U``, ``+U``, ``-D``) and stand in an order given by columns, by default snapshot
and sequence number. The net state needs no replay: of each key the last operation counts, and that is a maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import BROADCAST_ROWS, saved

ADD, DELETE = "ADD", "DELETE"
ORDER = ("_snapshot_id", "_seq")


def operation(kind: Column, update_before: str = "skip") -> Column:
    """ADD for +I and +U, DELETE for -D, null (no operation) for -U and unknown kinds.

    ``update_before='delete'`` makes -U a DELETE: an update that changes the key then removes the old document.
    """
    if update_before not in ("skip", "delete"):
        raise ValueError(f"update_before is 'skip' or 'delete', not '{update_before}'")
    deletes = ["-D", "-U"] if update_before == "delete" else ["-D"]
    return F.when(kind.isin("+I", "+U"), ADD).when(kind.isin(*deletes), DELETE)


def operations(rows: DataFrame, kind: str = "_row_kind", update_before: str = "skip") -> DataFrame:
    """Rows that are operations, with ``op``."""
    return rows.withColumn("op", operation(F.col(kind), update_before)).where("op is not null")


def fold(ops: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The last operation of each key, deletions included. Partial maxima before the shuffle: a hot key sends a row a task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in ops.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return ops.groupBy(*keys).agg(last).select(*keys, "_last.*").select(*ops.columns)


def live(ops: DataFrame, key: str | Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The rows of keys whose last operation is an ADD, without ``op``."""
    return fold(ops, key, order).where(F.col("op") == ADD).drop("op")


def batches(ops: DataFrame, by: str = "_bucket", order: Sequence[str] = ORDER, size: int = 1000) -> DataFrame:
    """Operations with ``run`` and ``batch``, as a writer of each bucket sends them: neighbours of one operation make a run, cut after ``size`` rows.

    A bucket is in order as a whole, but no task has to hold it: rows are dealt out by ranges of bucket and order, and
    saved. Runs are numbered within a range; a row for each range of a bucket, its pieces, then says how many runs came
    before it and how much of its first run.
    """
    if size <= 0:
        raise ValueError(f"a batch has at least one row, not {size}")
    rows = saved(ops.repartitionByRange(by, *order).withColumn("_piece", F.spark_partition_id()), "changes")
    piece = W.partitionBy("_piece", by).orderBy(*order)
    so_far = piece.rowsBetween(W.unboundedPreceding, 0)
    turned = F.when(F.lag("op").over(piece) != F.col("op"), 1).otherwise(0)
    local = rows.withColumn("_turned", turned).withColumn("_run", F.sum("_turned").over(so_far)).drop("_turned")
    local = local.withColumn("_place", F.row_number().over(W.partitionBy("_piece", by, "_run").orderBy(*order)) - 1)

    runs = local.groupBy("_piece", by, "_run").agg(F.first("op").alias("op"), F.count("*").alias("n"))
    last = F.max_by(F.struct("op", "n"), "_run")
    pieces = runs.groupBy("_piece", by).agg(F.min_by("op", "_run").alias("_first"), last.alias("_last"), F.max("_run").alias("_turns"))
    across = W.partitionBy(by).orderBy("_piece")
    before = across.rowsBetween(W.unboundedPreceding, -1)
    starts = F.coalesce(F.lag("_last.op").over(across) != F.col("_first"), F.lit(True))
    pieces = pieces.withColumn("_starts", starts)
    begun = F.sum(F.col("_starts").cast("long")).over(across.rowsBetween(W.unboundedPreceding, 0))
    pieces = pieces.withColumn("_base", begun + F.coalesce(F.sum("_turns").over(before), F.lit(0)))
    pieces = saved(pieces.withColumn("_end", F.col("_base") + F.col("_turns")), "pieces")
    # What earlier pieces hold of a piece's first run: they end in it.
    ending = W.partitionBy(by, "_end").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    whole = pieces.groupBy(by, F.col("_end").alias("_base")).agg(F.sum("_last.n").alias("_whole"))
    held = F.when(F.col("_turns") == 0, F.sum("_last.n").over(ending)).otherwise(F.col("_whole"))
    held = F.when(F.col("_starts"), 0).otherwise(F.coalesce(held, F.lit(0)))
    known = pieces.join(whole, [by, "_base"], "left").select("_piece", by, "_base", held.alias("_held"))
    placed = local.join(F.broadcast(known) if pieces.count() <= BROADCAST_ROWS else known, ["_piece", by])
    place = F.col("_place") + F.when(F.col("_run") == 0, F.col("_held")).otherwise(0)
    made = placed.withColumn("run", F.col("_base") + F.col("_run")).withColumn("batch", F.floor(place / F.lit(size)))
    return made.select(*ops.columns, "run", "batch")


def sent(ops: DataFrame, value: str, by: str = "_bucket", order: Sequence[str] = ORDER, size: int = 1000) -> DataFrame:
    """A row for each batch: its bucket, run, batch, operation, number of rows, and the values in order."""
    values = F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v"))))  # ``size`` at most
    made = batches(ops, by, order, size).groupBy(by, "run", "batch", "op").agg(F.count("*").alias("n"), values.alias("_vs"))
    return made.withColumn("values", F.transform("_vs", lambda s: s["_v"])).drop("_vs")


def quarantine(rows: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without an error, and the others with their ``_error``. Comes before the fold: a row that can't be read never hides the one before it."""
    marked = rows.withColumn("_error", error)
    return marked.where("_error is null").drop("_error"), marked.where("_error is not null")


def delete_ids(ops: DataFrame, key: str = "_id") -> DataFrame:
    """Distinct ids that deletions name."""
    return ops.where(F.col("op") == DELETE).select(key).distinct()


def without_ids(current: DataFrame, ids: DataFrame, key: str = "_id") -> DataFrame:
    """The documents whose id isn't named."""
    return current.join(ids.select(key), key, "left_anti")


def upsert(current: DataFrame, folded: DataFrame, key: str = "_id") -> DataFrame:
    """``current`` after the last operations of some keys: named keys go, and what was added comes."""
    kept = without_ids(current, folded, key)
    return kept.unionByName(folded.where(F.col("op") == ADD).select(*current.columns), allowMissingColumns=True)


def appended(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, by name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def require_key(columns: Sequence[str], key: str | None) -> str:
    """The key column of an index, checked against a source before anything runs."""
    if not key:
        raise ValueError("the index has no _ID field, so documents can't be replaced or deleted")
    if key not in columns:
        raise ValueError(f"the index's _ID field '{key}' isn't among the source's columns {list(columns)}")
    return key
