import collections

import corpus_pipeline
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, mixing, neardup
from tidemark.llm.common import saved


def test_stages(spark, fixture, empty):
    """Each stage judged on its own input."""
    path = fixture[0]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    bench = spark.read.parquet(f"{path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "token_records"]
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = saved(stage(spark, docs, path), "test")
        if name != "token_records":
            assert docs.columns == inputs["toxicity"].columns
    rows = {n: collections.Counter(map(tuple, d.collect())) for n, d in inputs.items()}
    assert rows["near_duplicates"] <= rows["toxicity"] and rows["decontamination"] <= rows["near_duplicates"]

    # Of each class one document is left, the one with the least id.
    named = inputs["near_duplicates"].withColumn("key", F.monotonically_increasing_id().cast("string")).select("key", "doc_id", "text")
    classes = neardup.near_duplicates(named).where("class_id is not null").groupBy("class_node").agg(F.min("doc_id").alias("i")).collect()
    left = collections.Counter(r["doc_id"] for r in inputs["decontamination"].select("doc_id").collect() if r["doc_id"] is not None)
    assert left == collections.Counter(r["i"] for r in classes)

    # Clean documents stay as they were, others have no window left.
    found = decontaminate.find_contamination(inputs["decontamination"].select("doc_id", "text"), bench)
    clean = collections.Counter((r["doc_id"], r["text"]) for r in found.where("n_hit = 0").collect())
    after = collections.Counter((r["doc_id"], r["text"]) for r in inputs["mixing"].select("doc_id", "text").collect())
    assert clean <= after and decontaminate.find_contamination(inputs["mixing"].select("doc_id", "text"), bench).where("n_hit > 0").count() == 0

    # The mix repeats what was there, twice at most, and its sources come near their targets.
    taken = rows["token_records"]
    assert all(n <= 2 * rows["mixing"][r] for r, n in taken.items())
    sizes = inputs["mixing"].select("source", mixing.n_tokens(F.col("text")).alias("size"))
    targets = {r["source"]: r["target"] for r in mixing.targets(sizes)[0].collect()}
    words = {r["source"]: r["n"] for r in inputs["token_records"].groupBy("source").agg(F.sum(mixing.n_tokens(F.col("text"))).alias("n")).collect()}
    largest = {r["source"]: r["n"] for r in sizes.groupBy("source").agg(F.max("size").alias("n")).collect()}  # whole documents can't come nearer
    assert all(abs(words.get(s, 0) - t) <= max(0.05 * t, largest[s] / 2) for s, t in targets.items())

    # One record for each document of the mix.
    assert docs.count() == inputs["token_records"].count()
    assert corpus_pipeline.run(spark, path).count() == docs.count()
    assert corpus_pipeline.run(spark, empty).count() == 0
