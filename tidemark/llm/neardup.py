"""N-gram Jaccard join: a MinHash LSH forest and exact verification.

Texts become sets of distinct five-word shingles. Texts with equal sets are one node, so copies never meet in pairs.
Each node has a label in each of TREES prefix trees: DEPTH minima of its shingles under as many hash functions, a byte
each, so that a prefix of a label is a path from a tree's root and sorted labels are the tree: nodes below a path stand
side by side. A tree is cut into buckets, each all nodes below one path, and nodes that share a bucket are candidates:

* Labels that no other label of the tree shares SHALLOW bytes with have no candidates there and are put away.
* From whole labels, prefixes are shortened as long as not more than FEW nodes share them, down to SHALLOW bytes. So a
  sparse part of a tree is searched widely and a dense one closely.
* A node whose prefixes are then so long that a text at the threshold would share a bucket with it in some tree with a
  probability below TARGET has its long ones shortened on, with those of all nodes below the same path, to the depth
  that reaches TARGET in every tree.

Candidates are compared exactly, in units of a bucket; of buckets with the same nodes one is kept. Where a connected
group of buckets holds no more pairs of nodes than its buckets together, it is one unit, so a set of shingles is read
once for it. So never more pairs are compared than the buckets hold, and a long chain of texts, each like the next
alone, costs what its buckets cost. Units of many nodes are compared block by block: a task has two blocks of a unit and
gives back each node's links and a spanning forest of the verified links, so what leaves a task grows with its nodes and
not with its pairs, and no unit has to fit into one task. A pair that shares several buckets counts in the first.

Defined results: null and empty texts, and texts without words, have no shingles and count as alike; texts of fewer
than five words have one shingle of all their words, and texts of any length are read whole; each row is a document, so
rows that repeat link to each other; a class is named by its least doc_id (null only if all are null), and of equal ones
any row stands for it; an empty table gives no rows; further columns are not read by the join and kept by
``drop_near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SQL_WORDS, narrow, saved, shuffle_width, small_batches, table, tidy, words_of
from .components import components
from .fingerprint import WordHashes, shingle_hashes

THRESHOLD, SHINGLE = 0.8, 5
TREES, DEPTH, TARGET = 20, 8, 0.995
#: Bytes of the shortest prefixes, and nodes that may share a prefix for it to be shortened further.
SHALLOW, FEW = 5, 64
#: Nodes, and shingles, that a block of a unit has on average at most.
BLOCK_NODES, BLOCK_SHINGLES = 256, 400_000
ROWS = 500


def meeting(depths: list[int], threshold: float = THRESHOLD) -> float:
    """Probability that two texts at the threshold share a prefix of these lengths, one for each tree, in some tree."""
    return 1 - math.prod(1 - threshold**d for d in depths)


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET) -> int:
    """The longest prefix that reaches ``target`` when all trees are cut at it."""
    while depth > 1 and meeting([depth] * trees, threshold) < target:
        depth -= 1
    return depth


def _functions(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    n = trees * depth
    return rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def labels_of(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """A label for each tree: ``depth`` bytes from the root on, in the high bytes of a 64-bit number."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), np.uint32(0xFFFFFFFF))
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 256):
            np.minimum(low, (x[at : at + 256, None] * a + b).min(axis=0), out=low)
        low = (low ^ low >> np.uint32(15)) * np.uint32(0x85EBCA6B)
    bytes_ = (low >> np.uint32(24)).astype(np.uint64).reshape(trees, depth)
    shifts = np.arange(56, 56 - 8 * depth, -8, dtype=np.uint64)
    return np.bitwise_or.reduce(bytes_ << shifts, axis=1).astype(np.int64)


def shingle_set(text: str | None, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(words_of((text or "").encode()), known, size))


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """key, doc_id, node, labels of every document; no labels for texts without shingles."""
    a, b = _functions(trees, depth)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            nodes, labels = [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, known)
                nodes.append(node_of(s))
                labels.append(labels_of(s, a, b, trees, depth) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(labels, pa.list_(pa.int64()))],
                names=["key", "doc_id", "node", "labels"],
            )

    return docs.select("key", "doc_id", "text").mapInArrow(tidy(sign), "key string, doc_id long, node binary, labels array<long>")


def _path(label: Column, depth: int) -> Column:
    """The first ``depth`` bytes of a label."""
    return F.shiftrightunsigned(label, 64 - 8 * depth)


def buckets(nodes: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET, few: int = FEW) -> DataFrame:
    """node, tree, depth, path: the buckets that nodes(node, labels) share with others, cut out of the trees as said above."""
    goal = prefix_depth(threshold, trees, DEPTH, target)
    shallow = min(SHALLOW, goal)
    each = nodes.select("node", F.posexplode("labels").alias("tree", "label")).withColumn("top", _path(F.col("label"), shallow))
    met = each.groupBy("tree", "top").agg(F.count("*").alias(f"n{shallow}")).where(f"n{shallow} > 1")
    # Sorted: a tree's labels in order, ranges of them in files. Equal labels are split by node.
    laid = saved(each.join(met, ["tree", "top"]).drop("top").repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node"), "forest")
    for d in range(shallow + 1, DEPTH):
        run = saved(laid.groupBy("tree", _path(F.col("label"), d).alias("run")).agg(F.count("*").alias(f"n{d}")), "forest-runs")
        laid = laid.withColumn("run", _path(F.col("label"), d)).join(run, ["tree", "run"]).drop("run")
    depth = F.lit(DEPTH)
    for d in range(DEPTH - 1, shallow - 1, -1):
        depth = F.when(F.col(f"n{d}") <= few, d).otherwise(depth)
    cut = saved(laid.select("node", "tree", "label", depth.cast("int").alias("depth")), "forest-cut")
    # A tree where a node has been put away is one that was searched for it at the shallowest depth.
    unmet = F.lit(trees) - F.count("*")
    missed = F.sum(F.log(1 - F.pow(F.lit(threshold), F.col("depth")))) + unmet * math.log(1 - threshold**shallow)
    needy = cut.groupBy("node").agg(missed.alias("missed"), F.max("depth").alias("longest"))
    needy = saved(needy.where((F.col("missed") > math.log(1 - target)) & (F.col("longest") > goal)).select("node"), "forest-needy")
    if not needy.isEmpty():
        long = cut.where(F.col("depth") > goal).withColumn("run", _path(F.col("label"), goal))
        widened = saved(long.join(needy, "node", "left_semi").select("tree", "run").distinct(), "forest-widened").withColumn("wide", F.lit(True))
        joined = cut.withColumn("run", F.when(F.col("depth") > goal, _path(F.col("label"), goal))).join(widened, ["tree", "run"], "left")
        cut = joined.select("node", "tree", "label", F.when(F.col("wide"), goal).otherwise(F.col("depth")).alias("depth"))
    path = F.lit(0).cast("long")
    for d in range(shallow, DEPTH + 1):
        path = F.when(F.col("depth") == d, _path(F.col("label"), d)).otherwise(path)
    return cut.select("node", "tree", "depth", path.alias("path"))


def units(nodes: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET) -> DataFrame:
    """node, units, homes: the units that a node is compared in, and its buckets by tree (0: none), null where it has a whole group for its unit."""
    key = ["tree", "depth", "path"]
    held = saved(buckets(nodes, threshold, trees, target), "buckets")
    members = F.sum(F.xxhash64("node").cast("decimal(38,0)"))
    runs = held.groupBy(*key).agg(F.count("*").alias("n"), F.min("node").alias("hub"), members.alias("who")).where("n > 1")
    # Of buckets with the same nodes that of the first tree is kept.
    first = runs.groupBy("n", "hub", "who").agg(F.min(F.struct(*key)).alias("k"))
    kept = saved(first.select("k.*", "n", "hub", F.xxhash64("k.tree", "k.depth", "k.path").alias("bucket")), "bucket-runs")
    held = saved(held.join(kept, key).select("node", "tree", "bucket", "hub"), "bucket-nodes")
    found = components(held.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    least = found.select(F.col("b").alias("node"), F.col("b").alias("cluster")).distinct()
    cluster = saved(found.select(F.col("a").alias("node"), F.col("b").alias("cluster")).unionByName(least), "clusters")
    sizes = cluster.groupBy("cluster").agg(F.count("*").cast("double").alias("nodes"))
    inside = kept.join(cluster, kept["hub"] == cluster["node"]).groupBy("cluster").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"))
    dense = saved(sizes.join(inside, "cluster").select("cluster", (F.col("nodes") * F.col("nodes") <= F.col("pairs")).alias("dense")), "cluster-sizes")
    placed = saved(cluster.join(dense, "cluster"), "placed")
    whole = placed.where("dense").select("node", F.array(F.xxhash64("cluster")).alias("units"), F.lit(None).cast("array<long>").alias("homes"))
    by_tree = F.map_from_entries(F.collect_list(F.struct("tree", "bucket")))  # a bucket a tree at most
    apart = held.join(placed.where("not dense").select("node"), "node").groupBy("node").agg(F.collect_list("bucket").alias("units"), by_tree.alias("by_tree"))
    homes = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.coalesce(F.try_element_at("by_tree", t), F.lit(0).cast("long")))
    return saved(whole.unionByName(apart.select("node", "units", homes.alias("homes"))), "units")


def member_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (rep, node, copies, units, homes) with the shingles of each node, taken from one document of it."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            keep, sets = [], []
            for i, (text, node) in enumerate(zip(batch.column("text").to_pylist(), batch.column("node").to_pylist(), strict=True)):
                s = shingle_set(text, known)
                if node_of(s) == node:  # equal keys may stand for other texts
                    keep.append(i)
                    sets.append(s.astype(np.int64))
            picked = batch.select(names).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(sets, pa.list_(pa.int64()))], names=[*names, "shingles"])

    names = ["node", "copies", "units", "homes"]
    found = docs.select("key", "text").join(narrow(members.select(F.col("rep").alias("key"), *names)), "key").select(*names, "text")
    return saved(found.mapInArrow(tidy(spell), "node binary, copies long, units array<long>, homes array<long>, shingles array<long>"), "shingle-sets")


def similar_pairs(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets are alike: a matrix left x right, or left x left with its diagonal off. Exact."""
    sets = left + (right or [])
    sizes = np.array([len(s) for s in sets])
    n = len(left)
    if len(sets) == 2:
        both = np.array([[len(np.intersect1d(sets[0], sets[1], assume_unique=True))]])
        counts = both if right else np.array([[0, both[0, 0]], [both[0, 0], 0]])
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1
        number = np.cumsum(shared) - 1
        keep = shared[column]
        owner, column = owner[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        counts = np.zeros((n, len(sets) - n if right else n), np.float32)
        width = 2048
        edges = np.searchsorted(column, np.arange(0, int(shared.sum()) + width, width))
        for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
            has = np.zeros((len(sets), width), np.float32)
            has[owner[lo:hi], column[lo:hi] - k * width] = 1
            rows = np.flatnonzero(has[:n].any(axis=1))
            if right:
                others = np.flatnonzero(has[n:].any(axis=1))
                counts[np.ix_(rows, others)] += has[rows] @ has[n + others].T
            else:
                counts[np.ix_(rows, rows)] += has[rows] @ has[rows].T
    mine, theirs = sizes[:n, None], (sizes[n:] if right else sizes)[None, :]
    alike = counts >= threshold * (mine + theirs - counts) - 1e-6
    alike &= counts > 0
    if not right:
        np.fill_diagonal(alike, False)
    return alike


def _forest(alike: np.ndarray, square: bool) -> list[tuple[int, int]]:
    """Edges that connect what ``alike`` connects; numbers on the right follow those on the left unless it is square."""
    n = alike.shape[0]
    parent = list(range(n + (0 if square else alike.shape[1])))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i in range(n):
        for j in np.flatnonzero(alike[i]).tolist():
            j = j if square else n + j
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                out.append((i, j))
    return out


def earlier(left: np.ndarray, right: np.ndarray, unit: int) -> np.ndarray:
    """Which pairs share a bucket of an earlier tree than that of ``unit``, from the nodes' buckets by tree (0: none)."""
    tree = int(np.flatnonzero(left[0] == unit)[0])
    out = np.zeros((len(left), len(right)), bool)
    for t in range(tree):
        out |= (left[:, t, None] == right[None, :, t]) & (left[:, t, None] != 0)
    return out


def verified(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b, texts, docs: for each node (b null) its links to other nodes and to their documents, in parts; and a spanning forest of all links."""
    sizes = sets.select(F.explode("units").alias("unit"), F.size("shingles").alias("size")).groupBy("unit").agg(F.count("*").alias("nodes"), F.sum("size").alias("total"))
    blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK_NODES), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    large = saved(sizes.select("unit", blocks.alias("blocks")).where("blocks > 1"), "unit-blocks")
    held = sets.withColumn("unit", F.explode("units")).drop("units").join(narrow(large), "unit", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    # A block meets itself and every other once: task (i, j) with i <= j.
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = held.withColumn("own", own).select("unit", "node", "copies", "homes", "shingles", "own", F.explode(others).alias("other"))
    dealt = dealt.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("other")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("texts", pa.int64()), ("docs", pa.int64())])

    def compare(members: dict[int, list[tuple]], unit: int, i: int, j: int) -> pa.RecordBatch:
        left, right = members.get(i, []), members.get(j, []) if i != j else None
        rows: list[tuple] = []
        if left and (right is None or right):
            alike = similar_pairs([m[2] for m in left], None if right is None else [m[2] for m in right], threshold)
            if left[0][3] is not None and alike.any():
                mine = np.array([m[3] for m in left])
                alike &= ~earlier(mine, mine if right is None else np.array([m[3] for m in right]), unit)
            both = left + (right or [])
            copies = np.array([m[1] for m in both], np.int64)
            theirs = copies if right is None else copies[len(left) :]
            for m, row in zip(left, alike, strict=True):
                if row.any():
                    rows.append((m[0], None, int(row.sum()), int(theirs[row].sum())))
            if right is not None:
                for m, column in zip(right, alike.T, strict=True):
                    if column.any():
                        rows.append((m[0], None, int(column.sum()), int(copies[: len(left)][column].sum())))
            rows += [(both[x][0], both[y][0], 0, 0) for x, y in _forest(alike, right is None)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, schema, strict=True)], schema=schema)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "i", "j", "own", "node", "copies", "homes")]
            shingles = batch.column("shingles")
            for row, (unit, i, j, part, node, copies, homes) in enumerate(zip(*columns, strict=True)):
                if (unit, i, j) != now:
                    if now:
                        yield compare(members, *now)
                    now, members = (unit, i, j), {}
                of = members.setdefault(part, [])
                if not of or of[-1][0] != node:  # repeated rows have given a node twice
                    of.append((node, copies, shingles[row].values.to_numpy(), homes))
        if now:
            yield compare(members, *now)

    # Pairs of blocks of one unit go to tasks in turn, so that a large unit is spread evenly. Equal (unit, i, j) stand
    # together in a partition and in order: a task holds one pair of blocks at a time.
    turn = F.pmod(F.xxhash64("unit") + (F.col("j") * (F.col("j") + 1) / 2).cast("long") + F.col("i"), F.lit(shuffle_width(sets))).cast("int")
    grouped = dealt.repartitionById(shuffle_width(sets), turn).sortWithinPartitions("unit", "i", "j", "own", "node")
    with small_batches(sets.sparkSession, ROWS):
        return saved(grouped.mapInArrow(tidy(walk), "a binary, b binary, texts long, docs long"), "links")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, target: float = TARGET) -> DataFrame:
    """key, doc_id, class_id, n_links (other documents alike), n_text_links (of these, different shingle sets), class_node.

    ``docs`` has key (string), doc_id and text.
    """
    docs = docs.select("key", F.col("doc_id").cast("long"), "text")
    with small_batches(docs.sparkSession, ROWS):
        rows = saved(signatures(docs, trees), "signatures")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.min("key").alias("rep"), F.count("*").alias("copies"), F.first("labels").alias("labels"))
    nodes = saved(nodes, "nodes")
    members = saved(nodes.select("node", "rep", "copies").join(units(nodes, threshold, trees, target), "node"), "members")
    with small_batches(docs.sparkSession, ROWS):
        links = verified(member_sets(docs, members), threshold)
    counts = links.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    roots = components(links.where("b is not null").select("a", "b")).select(F.col("a").alias("node"), F.col("b").alias("root"))
    known = nodes.select("node", "least", "copies").join(roots, "node", "left").join(counts, "node", "left")
    known = saved(known.withColumn("root", F.coalesce("root", "node")), "classes")
    # Only classes of several nodes need a look at their other nodes.
    firsts = known.where("texts > 0").groupBy("root").agg(F.min("least").alias("class_id"))
    named = known.join(firsts, "root", "left").select(
        "node",
        F.coalesce("class_id", "least").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        F.col("root").alias("class_node"),
    )
    return rows.select("key", "doc_id", "node").join(named, "node").drop("node")


def _keyed(docs: DataFrame) -> DataFrame:
    row_hash = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns])
    return docs.withColumn("_tm_key", F.concat_ws(":", F.col("doc_id").cast("string"), row_hash.cast("string")))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the least doc_id, in the columns of ``docs``; rows equal in all columns count as copies."""
    keyed = _keyed(docs)
    found = saved(near_duplicates(keyed.select(F.col("_tm_key").alias("key"), "doc_id", "text"), threshold).select("key", "doc_id", "class_node", "n_links"), "near")
    several = found.where("n_links > 0")
    first = several.groupBy("class_node").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).getField("key").alias("first"))
    first = narrow(saved(first, "near-first"))  # saved, so that Spark can split a hot class where it isn't broadcast
    lost = saved(several.join(first, "class_node").where("key <> first").select(F.col("key").alias("_tm_key")).distinct(), "near-lost")
    kept = keyed.join(narrow(lost), "_tm_key", "left_anti")
    if not several.groupBy("key").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["_tm_key"])
    return kept.select(*[f"`{c}`" for c in docs.columns])


def op10(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "n_links", "n_text_links")


OP10_SQL = f"""
with recursive doc as (select doc_id, {SQL_WORDS} w from documents),
gram as (select distinct doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') g
         from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) i from doc where len(w) > 0)),
bag as (select doc_id, count(*) n, md5(string_agg(g, chr(10) order by g)) id from gram group by 1),
sized as (select doc_id, coalesce(n, 0) n, coalesce(id, '') id from doc left join bag using (doc_id)),
met as (select a.doc_id a, b.doc_id b, count(*) c from gram a join gram b on a.g = b.g and a.doc_id <> b.doc_id group by all),
pair as (select a, b, y.id <> x.id other, y.id from met join sized x on x.doc_id = a join sized y on y.doc_id = b where c >= 0.8 * (x.n + y.n - c) - 1e-9
         union all select x.doc_id, y.doc_id, false, '' from sized x join sized y on x.n = 0 and y.n = 0 and x.doc_id <> y.doc_id),
reach(a, b) as (select doc_id, doc_id from doc union select reach.a, pair.b from reach join pair on reach.b = pair.a),
class as (select a doc_id, min(b) class_id from reach group by 1),
link as (select a doc_id, count(*) n_links, count(distinct id) filter (where other) n_text_links from pair group by 1)
select doc_id, class_id, coalesce(n_links, 0) n_links, coalesce(n_text_links, 0) n_text_links from class left join link using (doc_id)
"""
