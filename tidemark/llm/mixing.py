"""Mixing sources to target weights by balanced sampling (the cube method).

Sources, sorted by code point with null last, take the weights in turn, and share ``share`` times all words by weight.
No source's target passes ``cap`` times its words; what it can't take is shared anew among the others.
A document of a source with rate r = target / words is taken floor(r) times, and once more with probability r - floor(r).

The flight phase of the cube method moves these probabilities to 0 or 1 along the null space of two constraints, the
number of documents and the number of words, so both totals keep their values. It runs in blocks of a source's
documents at a time. A dozen documents of halving sizes are kept out of each flight; with its last two, LANDING at most,
they go to the next round's blocks until a source has one block, whatever the other sources have, or at once if the block has a document of over MISS of the
source's target. Then they are the landing problem, decided by trying all ways for the one nearest to the expected words. Should the nearest still miss by
more than MISS of the target, which takes a source of few and very unequal documents, further documents make up for it.

Defined results: null texts have no words, and texts of any length count whole; a source without words has target 0 and
takes nothing; rows that repeat are taken independently, and so are rows without an id; of ways that land equally near,
that with the nearest number of documents is taken, then the first; random numbers depend on the rows of a block alone, so
reruns agree; an empty table gives no rows; ``mix`` keeps further columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, saved, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, CAP = 1.5, 2.0
#: Documents of a source that one flight decides.
BLOCK = 4096
#: Equal rows that are dealt out by one task at a time.
COPIES = 100_000
#: Documents that a source's landing decides at most.
LANDING = 14
#: Share of a source's target by which its landing may miss before that is mended.
MISS = 0.002
#: With more sources than this, their targets are worked out by Spark and not on the driver.
DRIVER_SOURCES = 100_000
TOKEN = r"[^\x20\x09-\x0D]+"


def n_tokens(c) -> F.Column:
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0)).cast("long")


def reshared(sizes: list[int], weights: list[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """Targets of all sources: by weight, each at most ``cap`` times its size."""
    total, full = share * sum(sizes), [False] * len(sizes)
    while True:
        left = total - sum(cap * s for s, f in zip(sizes, full, strict=True) if f)
        open_weight = sum(w for w, f in zip(weights, full, strict=True) if not f)
        level = left / open_weight if open_weight else 0.0
        over = [not f and level * w > cap * s for s, w, f in zip(sizes, weights, full, strict=True)]
        if not any(over):
            return [cap * s if f else level * w for s, w, f in zip(sizes, weights, full, strict=True)]
        full = [f or o for f, o in zip(full, over, strict=True)]


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> tuple[DataFrame, bool]:
    """A row for each source of rows(source, size): its number in order, words, documents and target; and whether it is small."""
    spark = rows.sparkSession
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    if sums.count() <= DRIVER_SOURCES:
        found = sorted(sums.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
        ws = [weights[i % len(weights)] for i in range(len(found))]
        ts = reshared([r["source_size"] for r in found], ws, share, cap)
        made = [(r["source"], i, r["source_size"], r["n_docs"], float(t)) for i, (r, t) in enumerate(zip(found, ts, strict=True))]
        return spark.createDataFrame(made, "source string, number long, source_size long, n_docs long, target double"), True
    ordered = sums.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0][0], x[1], x[0][1], x[0][2]))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    sources = saved(spark.createDataFrame(ordered, "source string, number long, source_size long, n_docs long").withColumn("w", weight), "sources")
    total = share * sources.agg(F.sum("source_size")).first()[0]
    level = 0.0
    while True:
        full = F.lit(level) * F.col("w") > F.lit(cap) * F.col("source_size")
        kept, open_weight = sources.agg(F.sum(F.when(full, cap * F.col("source_size")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        raised = (total - kept) / open_weight if open_weight else 0.0
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(F.lit(level) * F.col("w"), F.lit(cap) * F.col("source_size"))).drop("w"), False


def flight(p: np.ndarray, x: list[int], rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities p to 0 or 1 but for two at most, keeping sum(p) and sum(p * x)."""
    p, held = [float(v) for v in p], []
    draws: list[float] = []
    for unit in range(len(p)):
        if not 0.0 < p[unit] < 1.0:
            continue
        held.append(unit)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])  # orthogonal to (1, 1, 1) and to the sizes
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = down = float("inf")
        for k, v in zip(held, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[k]) / v), min(down, p[k] / v)
            elif v < 0:
                up, down = min(up, p[k] / -v), min(down, (1 - p[k]) / -v)
        if not draws:
            draws = rng.random(256).tolist()
        step = up if draws.pop() * (up + down) < down else -down
        for k, v in zip(held, u, strict=True):
            q = p[k] + step * v
            p[k] = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
        held = [k for k in held if 0.0 < p[k] < 1.0]
    return np.array(p)


def kept_back(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Up to LANDING - 2 undecided documents whose sizes fall by halves, from which almost any number of words can be made up."""
    left = [int(k) for k in np.flatnonzero((p > 0) & (p < 1))]
    out: list[int] = []
    goal = max((x[k] for k in left), default=0) / 2
    while left and len(out) < LANDING - 2:
        best = min(left, key=lambda k: (abs(x[k] - goal), k))
        left.remove(best)
        out.append(best)
        goal = max(goal / 2, 1)
    return np.array(out, dtype=int)


def land(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Decides the last documents, LANDING at most: of all ways the one that comes nearest to their expected words, then to their expected number."""
    left = np.flatnonzero((p > 0) & (p < 1))
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words, number = np.abs(ways @ x[left] - p[left] @ x[left]), np.abs(ways.sum(1) - p[left].sum())
    p[left] = ways[np.lexsort((number, np.round(words, 6)))[0]]
    return p


def mended(p: np.ndarray, x: np.ndarray, free: np.ndarray, error: float) -> np.ndarray:
    """Where few large documents make up a source, the landing can miss by one of them: the largest others that fit make up for it.

    ``error`` is what was taken too little; ``free`` marks the documents that this round decided.
    """
    for k in np.argsort(-x, kind="stable"):
        if free[k] and 0 < x[k] <= abs(error) and p[k] == (0.0 if error > 0 else 1.0):
            p[k] = 1.0 - p[k]
            error -= x[k] if error > 0 else -x[k]
    return p


def _decide(level: int, size: int):
    """What a round does with a block: the flight, and for a source of one block of at most ``size`` documents the landing."""

    def decide(key, block):
        columns = block.columns
        block = block.sort_values(["size", "key"], ascending=[False, True], kind="stable", ignore_index=True)
        p, x = block["p"].to_numpy(copy=True), block["size"].to_numpy()
        n, target = (block[c].iloc[0] for c in ("n_docs", "target"))
        # A document beyond MISS is decided here, where a whole block can make up for it; few documents are left later.
        last = n <= size or x.max() > MISS * target
        back = kept_back(p, x)
        free, due = (p > 0) & (p < 1), float(p @ x)
        held, p[back] = p[back], 0.0
        p = flight(p, x.tolist(), np.random.default_rng([level, int(key[0]), int(key[1])]))
        p[back] = held
        if last:
            p = land(p, x)
            error = due - float(p @ x)
            if abs(error) > MISS * target * min(1, len(p) / n):
                p = mended(p, x, free, error)
        block["p"] = p
        return block[[c for c in columns if c != "_block"]]

    return decide


def numbered(rows: DataFrame) -> DataFrame:
    """rows(key, source, size), saved by the caller, with ``copy``, a number of each among equal rows.

    Equal rows are counted before they meet, and dealt out again in parts of COPIES: no task has all of a hot key.
    """
    counts = rows.groupBy("key", "source", "size").agg(F.count("*").alias("n"))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))
    parts = counts.withColumn("part", part).repartition("key", "source", "size", "part")
    last = F.least(F.col("n"), (F.col("part") + 1) * COPIES) - 1
    return parts.select("key", "source", "size", F.explode(F.sequence(F.col("part") * COPIES, last)).alias("copy"))


def choose(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """rows(key, source, size), read several times, with source_size, target and times (how often each row is taken).

    ``key``, a string, orders rows and makes their random numbers; equal rows are interchangeable.
    """
    spark = rows.sparkSession
    plan, small = targets(rows, weights, share, cap)
    hint = F.broadcast if small else (lambda df: df)
    plan = plan.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    known = numbered(rows).join(hint(plan), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn("_rate", rate)
    known = known.withColumns({"times": F.floor("_rate"), "p": F.col("_rate") - F.floor("_rate")})
    kept = ["key", "source", "size", "source_size", "target", "times"]
    parts = [known.where("p = 0").select(*kept)]
    state = known.where("p > 0").select(*kept, "p", "number", "n_docs", "copy")
    schema = state.schema
    most, level = plan.agg(F.max("n_docs")).first()[0] or 0, 0
    while True:
        # Undecided rows per source are known in advance: all at first, then LANDING for each block at most.
        blocks = F.ceil(F.col("n_docs") / BLOCK)

        # A block is a hash range of its source's rows: a hot source has as many blocks as its rows need. Equal rows go to
        # blocks in turn, so how many a block has of them is the same in every run.
        blocked = state.withColumn("_block", F.pmod(F.xxhash64("key", "size", F.lit(level)) + F.col("copy"), blocks).cast("long"))
        path = fresh_path(spark, f"flight-{level}")
        blocked.groupBy("number", "_block").applyInPandas(_decide(level, BLOCK), schema).write.parquet(path)
        done = spark.read.schema(schema).parquet(path)
        whole = F.col("p").isin(0.0, 1.0)
        parts.append(done.where(whole).withColumn("times", F.col("times") + F.col("p").cast("long")).select(*kept))
        if most <= BLOCK:
            break
        state = done.where(~whole).withColumn("n_docs", LANDING * F.ceil(F.col("n_docs") / BLOCK))
        most, level = LANDING * -(-most // BLOCK), level + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The documents of the mix, in the columns of ``docs``; one taken twice is there twice."""
    # Two numbers name a row: its id and a hash of all its columns. Rows of one name count as copies.
    row_hash = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns])
    key = F.concat_ws(":", F.col("doc_id").cast("string"), row_hash.cast("string"))
    rows = saved(docs.select(key.alias("key"), "source", n_tokens(F.col("text")).alias("size")), "mix-rows")
    names = F.col("key").alias("_tm_key")
    chosen = choose(rows, weights, share, cap).groupBy(names).agg(F.sum("times").alias("_tm_times"), F.count("*").alias("_tm_copies"))
    chosen = saved(chosen.where("_tm_times > 0"), "mix-chosen")
    named = docs.withColumn("_tm_key", key)
    if not chosen.where("_tm_copies > 1").isEmpty():
        named = named.dropDuplicates(["_tm_key"])
    taken = named.join(chosen, "_tm_key").withColumn("_tm_n", F.explode(F.sequence(F.lit(1), F.col("_tm_times").cast("int"))))
    return taken.select(*[f"`{c}`" for c in docs.columns])


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = saved(docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "source", n_tokens(F.col("text")).alias("size")), "mix-rows")
    return choose(rows).select(F.expr("try_cast(nullif(key, '') as bigint)").alias("doc_id"), "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))
