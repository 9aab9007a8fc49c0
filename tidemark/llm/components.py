"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, remove, saved


def _downward(pairs: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller end."""
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """a, b: each node of edges(a, b) that is not its component's least, and that least node.

    A round links every node's larger neighbours to its least neighbour (large star), then all its smaller neighbours
    (small star). No round gathers a node's neighbours: a hub of a third of all nodes is one minimum and one join. The
    minima are saved before they are joined, so that both sides of a join come straight from a shuffle and Spark can split
    a hub's share among tasks. Rounds end when edges no longer change; their number grows with the logarithm of a
    component's size. Every round is written to the shared folder, which cuts the lineage.
    """
    spark, kind = edges.sparkSession, edges.schema
    path = fresh_path(spark, "edges")
    _downward(edges).write.parquet(path)
    now, state = spark.read.schema(kind).parquet(path), None
    while (after := _state(now)) != state:
        state, old = after, path
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "large-star")
        large = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(_downward(large), "edges")
        small = saved(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "small-star")
        linked = large.join(small, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        path = fresh_path(spark, "edges")
        _downward(linked.select("e.*")).write.parquet(path)
        now = spark.read.schema(kind).parquet(path)
        remove(spark, old)
    return now
