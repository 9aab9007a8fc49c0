"""Line dedup over levelled sorted runs of line hashes, in DataFrame operations only.

The store keeps runs: files bucketed and sorted by a line's 128-bit hash, a row for each hash with the number of
documents that held it, whether the run was the first to hold it, and the largest doc_id among them, its owner. A batch
is hashed, reduced to a row a hash, and merge-anti-joined with the runs: what none of them knows is new, the rest adds to
counts. The result is one more run of level 0. As soon as a level has ``fanout`` runs they are merged into one of the next
level, so a store of n batches has some fanout * log(n) runs, and batches may come in any order of doc_id. Buckets of all
runs agree, so the joins and merges shuffle nothing. A job's store is closed when its frequent lines are saved, or when it
fails, and takes its tables with it.

Defined results: a null or empty text is one empty line; texts and lines of any length are taken whole; each row is a
document, and rows that repeat count as often; null doc_ids come before all others; ties of the largest doc_id all own
the line; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, id_cuts, lower_ascii, remove, saved, table

BLANK = " \t\n\x0b\x0c\r"
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Batches of a job at least, documents of a batch at most, and runs of a level that are merged.
BATCHES, BATCH_DOCS, FANOUT = 4, 100_000_000, 2
KEYS = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANK)))


def long_keys(text: Column, least: int) -> Column:
    """Distinct keys of a text's lines that have ``least`` code points or more."""
    # Lines that are short as they stand are not worth folding.
    long = F.filter(lines_of(text), lambda line: F.length(line) >= least)
    return F.array_distinct(F.filter(F.transform(long, line_key), lambda k: F.length(k) >= least))


def hashed_lines(docs: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """doc_id, h1, h2: a row for each document and distinct long key."""
    keys = docs.select("doc_id", F.explode(long_keys(F.col("text"), least)).alias("k"))
    return keys.select("doc_id", F.xxhash64("k").alias("h1"), F.xxhash64(F.lit(1), "k").alias("h2"))


class LineRuns:
    """The store; a context that drops its tables at the end."""

    def __init__(self, spark, buckets: int | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []
        self.made: set[tuple[str, str]] = set()

    def __enter__(self) -> LineRuns:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        """Drops all runs."""
        for run in self.made.copy():
            self._drop(run)
        self.levels = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"line_run_{uuid4().hex}", fresh_path(self.spark, "line-run")
        self.made.add((name, path))
        rows.write.bucketBy(self.buckets, *KEYS).sortBy(*KEYS).option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"drop table if exists {run[0]}")
        remove(self.spark, run[1])
        self.made.discard(run)

    def add(self, docs: DataFrame, least: int = LEAST_CHARS) -> None:
        seen = hashed_lines(docs, least).groupBy(*KEYS).agg(F.count("*").alias("n"), F.lit(True).alias("fresh"), F.max("doc_id").alias("owner"))
        batch = self._write(seen)
        runs = [run.where("fresh").select(*KEYS) for run in self.runs()]
        if runs:
            rows = self.spark.table(batch[0])
            new = reduce(lambda left, run: left.join(run.hint("merge"), KEYS, "left_anti"), runs, rows)
            # A hash is fresh in one run only, so these don't overlap.
            known = [rows.join(run.hint("merge"), KEYS, "left_semi").withColumn("fresh", F.lit(False)) for run in runs]
            run = self._write(reduce(DataFrame.unionByName, known, new))
            self._drop(batch)
            batch = run
        self._push(batch, 0)

    def _push(self, run: tuple[str, str], level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged([self.spark.table(n) for n, _ in self.levels[level]]))
            for old in self.levels[level]:
                self._drop(old)
            self.levels[level] = []
            self._push(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """Two runs at a time by a merge join: a union's buckets would not be known to fit together."""

        def two(left: DataFrame, right: DataFrame) -> DataFrame:
            other = right.select(*KEYS, F.col("n").alias("n_"), F.col("fresh").alias("fresh_"), F.col("owner").alias("owner_")).hint("merge")
            zero = F.lit(0).cast("long")
            n = F.coalesce("n", zero) + F.coalesce("n_", zero)
            fresh = F.coalesce("fresh", F.lit(False)) | F.coalesce("fresh_", F.lit(False))
            return left.join(other, KEYS, "full_outer").select(*KEYS, n.alias("n"), fresh.alias("fresh"), F.greatest("owner", "owner_").alias("owner"))

        return reduce(two, runs)

    def counts(self) -> DataFrame:
        """h1, h2, n, owner of all lines so far."""
        return self._merged(self.runs()).drop("fresh")


def batches_of(docs: DataFrame, batches: int) -> list[DataFrame]:
    """The documents in ranges of doc_id, the highest first; a range reaches the scan as a filter."""
    c = F.col("doc_id")
    cuts = id_cuts(docs, "doc_id", batches)
    edges = [None, *cuts, None]
    out = []
    for lo, hi in reversed(list(zip(edges, edges[1:], strict=False))):
        part = docs
        if lo is not None:
            part = part.where(c >= lo)
        if hi is not None:
            part = part.where((c < hi) if lo is not None else (c < hi) | c.isNull())
        out.append(part)
    return out


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int | None = None) -> DataFrame:
    """doc_id, text without its dropped lines, n_lines before, n_dropped."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    batches = batches or max(BATCHES, -(-docs.count() // BATCH_DOCS))
    with LineRuns(docs.sparkSession) as store:
        for batch in batches_of(docs, batches):
            store.add(batch, least_chars)
        # Saved, so that both sides of the join come straight from a shuffle and Spark can split a hot line's share among tasks.
        frequent = saved(store.counts().where(F.col("n") >= least_docs).select(*KEYS, F.col("owner")), "frequent-lines")
    lost = (
        hashed_lines(docs, least_chars)
        .join(frequent, KEYS)
        .where(~F.col("doc_id").eqNullSafe(F.col("owner")))
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.collect_set("h1").alias("_lost"))
    )
    joined = docs.join(lost.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")

    def kept(line: Column) -> Column:
        key = line_key(line)
        return ~((F.length(key) >= least_chars) & F.array_contains("_lost", F.xxhash64(key)))

    lines = lines_of(F.col("text"))
    left = F.when(F.col("_lost").isNull(), lines).otherwise(F.filter(lines, kept))
    out = joined.select("doc_id", F.size(lines).cast("long").alias("n_lines"), left.alias("_left"))
    return out.select("doc_id", F.array_join("_left", "\n").alias("text"), "n_lines", (F.col("n_lines") - F.size("_left")).alias("n_dropped"))


def op3(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP3_SQL = """
with doc as (select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
line as (select r, doc_id, unnest(l) line, generate_subscripts(l, 1) pos from doc),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k from line),
frequent as (select k, max(doc_id) owner from keyed where length(k) >= 40 group by k having count(distinct r) >= 5),
marked as (select keyed.*, frequent.k is not null and doc_id is distinct from owner gone from keyed left join frequent on keyed.k = frequent.k)
select doc_id, count(*) n_lines, count(*) filter (where gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) kept_sha256
from marked group by r, doc_id
"""
