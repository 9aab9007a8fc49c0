import pytest
from pyspark.sql import functions as F

from tidemark.functions.encode import TOPIC, Policy
from tidemark.plans import search as Q
from tidemark.plans.document import documents
from tidemark.sources.index import Field, IndexCatalog, IndexSchema, MissingIndex
from tidemark.streaming.runner import Ingest

FIELDS = [
    Field("id", "_ID", doc_values=True), Field("title", "TEXT", search=True), Field("content", "TEXT", search=True), Field("category", "ATOM", search=True),
    Field("rating", "DOUBLE", doc_values=True), Field("tags", "ATOM", multi=True), Field("metadata_author", "ATOM"), Field("hidden", "ATOM", store=False),
]
LAKE = "id string, title string, content string, category string, rating double, tags array<string>, _row_kind string, _bucket int, _snapshot_id long, _seq long"


@pytest.fixture
def catalog(spark, tmp_path):
    made = IndexCatalog(spark, f"file://{tmp_path}/indexes")
    made.create("docs")
    made.register("docs", FIELDS)
    made.start("docs")
    return made


def change(user, version, category, kind, bucket, snapshot, seq):
    return (user, f"User {user} Document v{version}", f"content of {user}", category, version + 3.0, ["test", f"version{version}"], kind, bucket, snapshot, seq)


SNAPSHOTS = [
    [change("user123", 1, "initial", "+I", 0, 1, 0), change("user789", 1, "initial", "+I", 0, 1, 1), change("user456", 1, "initial", "+I", 1, 1, 2)],
    [change("user123", 1, "initial", "-U", 0, 2, 3), change("user123", 2, "updated", "+U", 0, 2, 4), change("user999", 1, "new", "+I", 0, 2, 5), change("user456", 2, "updated", "+U", 1, 2, 6)],
    [change("user123", 3, "final", "+U", 0, 3, 7)],
]


def test_latest_version_wins(spark, catalog):
    ingest = Ingest(catalog, "docs", policy=Policy("multi", "json"))
    for batch, rows in enumerate(SNAPSHOTS):
        ingest.apply_changes(spark.createDataFrame(rows, LAKE), batch)
    index = catalog.open("docs")
    got = {r["id"]: (r["category"], r["rating"], r["tags"]) for r in index.table().collect()}
    assert got == {"user123": ("final", 6.0, ["test", "version3"]), "user456": ("updated", 5.0, ["test", "version2"]), "user789": ("initial", 4.0, ["test", "version1"]), "user999": ("new", 4.0, ["test", "version1"])}
    assert [r["id"] for r in Q.search(index, Q.Term("category", "final")).hits.collect()] == ["user123"]
    assert Q.search(index, Q.Term("tags", "version2")).total == 1
    assert ingest.progress.batches == 3 and ingest.progress.docs == 8


def test_all_snapshots_at_once_come_to_the_same(spark, catalog):
    Ingest(catalog, "docs").apply_changes(spark.createDataFrame([r for s in reversed(SNAPSHOTS) for r in s], LAKE))
    assert {r["id"]: r["category"] for r in catalog.open("docs").table().collect()} == {"user123": "final", "user456": "updated", "user789": "initial", "user999": "new"}


def test_insert_delete_insert(spark, catalog):
    ingest = Ingest(catalog, "docs")
    steps = [("First Version", "+I"), ("First Version", "-D"), ("Second Version", "+I")]
    for n, (title, kind) in enumerate(steps):
        ingest.apply_changes(spark.createDataFrame([("u", title, "", "c", 1.0, None, kind, 0, n, n)], LAKE), n)
        assert catalog.open("docs").documents().count() == (0 if kind == "-D" else 1)
    assert catalog.open("docs").table().first()["title"] == "Second Version"


@pytest.mark.parametrize("merge_deltas", [2, 16])
def test_older_operations_that_come_later_change_nothing(spark, catalog, monkeypatch, merge_deltas):
    """Batches in any order, with any merges between, come to what a replay in the order of snapshots leaves."""
    import random

    from tidemark.sources import index as I

    monkeypatch.setattr(I, "MERGE_DELTAS", merge_deltas)
    rng, index = random.Random(7), catalog.open("docs")
    log = [(rng.choice(["ADD", "ADD", "DELETE"]), f"k{rng.randrange(8)}", {"title": [f"t{n}"]}, n // 4, n) for n in range(40)]
    parts = [log[n : n + 5] for n in range(0, 40, 5)]
    rng.shuffle(parts)
    for n, part in enumerate(parts):
        index.apply(spark.createDataFrame(part, "op string, _id string, doc map<string,array<string>>, _snapshot_id long, _seq long"), batch=n)
    want = {}
    for op, k, doc, _, _ in log:
        want.pop(k, None) if op == "DELETE" else want.update({k: doc["title"][0]})
    assert {r["_id"]: r["doc"]["title"][0] for r in index.documents().collect()} == want
    index.delete(["k0"])
    assert "k0" not in {r["_id"] for r in index.documents().collect()}
    # Another source has an order of its own.
    index.apply(spark.createDataFrame([("ADD", "k1", {"title": ["other"]}, 0, 0)], "op string, _id string, doc map<string,array<string>>, _snapshot_id long, _seq long"), source="b")
    assert {r["_id"]: r["doc"]["title"][0] for r in index.documents().collect()}["k1"] == "other"


def test_a_batch_is_applied_once(spark, catalog):
    ingest = Ingest(catalog, "docs")
    rows = spark.createDataFrame(SNAPSHOTS[0], LAKE)
    assert ingest.apply_changes(rows, 4) == ingest.apply_changes(rows, 4) == ingest.apply_changes(rows, 3) == 1
    assert ingest.apply_changes(rows, 4, source="other") == 2


def test_versions(spark, catalog):
    index = catalog.open("docs")
    docs = documents(spark.createDataFrame([("a", "x"), ("b", "y")], "_id string, title string"), keep=["_id"], meta=["_id"])
    before = index.documents()
    assert index.add(docs) == 1 and before.count() == 0
    assert index.delete(["a", "zz"]) == 2 and [r["_id"] for r in index.documents().collect()] == ["b"]
    assert index.add(docs) == 3
    index.expire(1)
    assert index.documents().count() == 2
    with pytest.raises(ValueError):
        index.delete([])


def test_deltas_are_merged(spark, catalog, monkeypatch):
    """Whatever the deltas and merges, documents are those of a plain replay."""
    import random

    from tidemark.sources import index as I

    monkeypatch.setattr(I, "MERGE_DELTAS", 4)
    rng, state, index = random.Random(1), {}, catalog.open("docs")
    for step in range(9):
        ops = {f"k{rng.randrange(12)}": rng.choice(["ADD", "ADD", "DELETE"]) for _ in range(4)}
        rows = [(op, k, {"title": [f"{k} {step}"]}, step, 0) for k, op in ops.items()]
        index.apply(spark.createDataFrame(rows, "op string, _id string, doc map<string,array<string>>, _snapshot_id long, _seq long"), batch=step)
        for k, op in ops.items():
            state.pop(k, None) if op == "DELETE" else state.update({k: f"{k} {step}"})
        assert {r["_id"]: r["doc"]["title"][0] for r in index.documents().collect()} == state
        assert len(index._pointer(index.version)["deltas"]) < 4
    index.expire()
    assert index.documents().count() == len(state)


def test_appends_between_merges(spark, tmp_path):
    catalog = IndexCatalog(spark, f"file://{tmp_path}/indexes")
    catalog.create("a")
    catalog.register("a", [Field("id", "ATOM")])
    index = catalog.start("a")
    docs = spark.createDataFrame([("x", {"id": ["1"]}), ("y", {"id": ["1"]})], "_id string, doc map<string,array<string>>")
    index.append(docs, 0)
    index.append(docs, 1)
    index.delete(["x"])
    index.append(docs.where("_id = 'x'"), 2)
    assert sorted(r["_id"] for r in index.documents().collect()) == ["x", "y", "y"]


def test_lifecycle(spark, tmp_path):
    catalog = IndexCatalog(spark, f"file://{tmp_path}/indexes")
    with pytest.raises(MissingIndex, match="does not exist"):
        catalog.open("a")
    catalog.create("a")
    with pytest.raises(ValueError):
        catalog.create("a")
    with pytest.raises(MissingIndex):
        catalog.open("a")
    catalog.register("a", FIELDS[:2])
    for again in ([FIELDS[0]], [Field("id2", "_ID")]):
        with pytest.raises(ValueError):
            catalog.register("a", again)
    assert catalog.start("a").schema.id_field == "id"
    with pytest.raises(ValueError):
        Field("x", "POINT")
    with pytest.raises(KeyError):
        IndexSchema([]).field("x")


def test_queries(spark, catalog):
    index = catalog.open("docs")
    rows = [
        ("doc1", "Machine Learning Basics", "Introduction to neural networks and deep learning concepts", "technology", 4.5, ["ml", "ai"], ("Alice Smith",)),
        ("doc2", "Cooking Pasta Perfectly", "Tips and tricks for making restaurant-quality pasta at home", "cooking", 4.8, ["food"], ("Chef Mario",)),
        ("doc3", "Travel Guide: Tokyo", "Best places to visit and authentic food experiences in Tokyo", "travel", 4.2, None, ("Travel Blogger",)),
    ]
    df = spark.createDataFrame(rows, "id string, title string, content string, category string, rating double, tags array<string>, metadata struct<author:string>")
    index.add(documents(df.withColumn("_id", F.col("id")), keep=["_id"], meta=["_id"], policy=TOPIC))
    assert Q.search(index, Q.MatchAll()).total == Q.search(index, Q.Empty()).total == 3
    assert [r["id"] for r in Q.search(index, Q.Term("category", "technology")).hits.collect()] == ["doc1"]
    assert Q.search(index, Q.Term("category", "Technology")).total == 0
    found = Q.search(index, Q.Match("content", "pasta COOKING")).hits.collect()
    assert [r["id"] for r in found] == ["doc2"] and found[0]["score"] > 0
    assert Q.search(index, Q.TermInSet("id", ["doc1", "doc3", "none"])).total == 2
    assert Q.search(index, Q.Term("tags", "food")).total == 1 and Q.search(index, Q.TermInSet("tags", ["ai", "food"])).total == 2
    assert Q.search(index, Q.Term("rating", 4.5)).total == 1
    page = Q.search(index, Q.MatchAll(), 1, 2, ["rating", "metadata_author"])
    assert page.total == 3 and [tuple(r) for r in page.hits.collect()] == [("doc2", 1.0, 4.8, "Chef Mario")]
    assert index.table().select(Q.rendered(F.col("rating"))).orderBy("_id").first()[0] == "4.5"
    with pytest.raises(ValueError):
        Q.search(index, Q.MatchAll(), fields=["hidden"])
    with pytest.raises(ValueError):
        Q.search(index, Q.Match("category", "x"))
    with pytest.raises(ValueError):
        Q.TermInSet("id", [])
    assert Q.search(index, Q.Match("content", " ... ")).total == 0


def test_bm25_against_its_formula(spark):
    import math

    texts = {"a": "x y z", "b": "x x w w w w", "c": "q", "d": ""}
    df = spark.createDataFrame(list(texts.items()), "_id string, t string")
    got = {r["_id"]: r["score"] for r in Q.bm25(df, "_id", "t", "X z").collect()}
    words = {k: t.split() for k, t in texts.items()}
    mean = sum(map(len, words.values())) / 4
    for k, ws in words.items():
        want = 0.0
        for q in ("x", "z"):
            df_q, tf = sum(q in w for w in words.values()), ws.count(q)
            want += math.log(1 + (4 - df_q + 0.5) / (df_q + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ws) / mean))
        assert got.get(k, 0.0) == pytest.approx(want)
