import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LakeConfig, TopicConfig
from tidemark.plans import search as Q
from tidemark.sources import lake, topic
from tidemark.sources.index import Field, IndexCatalog, MissingIndex
from tidemark.streaming import runner as R

LAKE = "id string, title string, _row_kind string, _bucket int, _snapshot_id long, _seq long"


def catalog_of(spark, path, *fields):
    made = IndexCatalog(spark, f"file://{path}/indexes")
    made.create("docs")
    made.register("docs", fields or [Field("id", "_ID"), Field("title", "TEXT", search=True)])
    made.start("docs")
    return made


def lake_of(tmp_path, **more):
    return LakeConfig.read({"database.name": "db", "table.name": "t", "target.index.name": "docs", "warehouse.path": str(tmp_path / "w"), **more})


def put(spark, config, rows):
    spark.createDataFrame(rows, LAKE).coalesce(1).write.mode("append").parquet(lake.table_path(config))


def run_once(spark, ingest, config, checkpoint):
    q = ingest.start_lake(lake.stream_table(spark, config, "svc", files=1), str(checkpoint), once=True)
    q.awaitTermination()
    assert q.exception() is None


def test_follow_a_lake_table(spark, tmp_path):
    """Full table first, then what came since; a restart goes on from the checkpoint."""
    config, catalog = lake_of(tmp_path), catalog_of(spark, tmp_path)
    ingest = R.Ingest(catalog, "docs")
    put(spark, config, [("a", "one", "+I", 0, 1, 1), ("b", "two", "+I", 0, 1, 2)])
    run_once(spark, ingest, config, tmp_path / "c")
    put(spark, config, [("a", "one again", "+U", 0, 2, 3), ("b", "two", "-D", 0, 2, 4), ("c", "three", "+I", 0, 2, 5)])
    run_once(spark, R.Ingest(catalog, "docs"), config, tmp_path / "c")
    assert {r["id"]: r["title"] for r in catalog.open("docs").table().collect()} == {"a": "one again", "c": "three"}
    version = catalog.open("docs").version
    run_once(spark, R.Ingest(catalog, "docs"), config, tmp_path / "c")
    assert catalog.open("docs").version == version


def test_a_crash_after_publication_applies_nothing_twice(spark, tmp_path):
    """The batch is published, then the driver dies before the offsets are committed: the batch comes again and is passed over."""
    config, catalog = lake_of(tmp_path), catalog_of(spark, tmp_path)
    put(spark, config, [("a", "one", "+I", 0, 1, 1)])

    class Dying(R.Ingest):
        def apply_changes(self, *args, **kw):
            super().apply_changes(*args, **kw)
            raise RuntimeError("died")

    q = Dying(catalog, "docs").start_lake(lake.stream_table(spark, config, "svc"), str(tmp_path / "c"), once=True)
    with pytest.raises(Exception, match="died"):
        q.awaitTermination()
    assert catalog.open("docs").version == 1
    run_once(spark, R.Ingest(catalog, "docs"), config, tmp_path / "c")
    assert catalog.open("docs").version == 1 and catalog.open("docs").documents().count() == 1


def test_poison_rows_go_to_quarantine(spark, tmp_path):
    config, catalog = lake_of(tmp_path), catalog_of(spark, tmp_path)
    put(spark, config, [("a", "good", "+I", 0, 1, 1), ("a", "bad", "+U", 0, 1, 2), ("b", "fine", "+I", 0, 1, 3)])
    ingest = R.Ingest(catalog, "docs", error=lambda df: F.when(F.col("title") == "bad", "title"), quarantine_to=str(tmp_path / "q"))
    run_once(spark, ingest, config, tmp_path / "c")
    assert {r["id"]: r["title"] for r in catalog.open("docs").table().collect()} == {"a": "good", "b": "fine"}
    assert [r["_error"] for r in spark.read.parquet(str(tmp_path / "q")).collect()] == ["title"]


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    """Neither its rows that can't be converted nor its progress are there twice, whether it was published before or not."""
    catalog = catalog_of(spark, tmp_path)
    rows = spark.createDataFrame([("a", "good", "+I", 0, 1, 1), ("b", "bad", "+I", 1, 1, 2)], LAKE)
    ingest = R.Ingest(catalog, "docs", error=lambda df: F.when(F.col("title") == "bad", "title"), quarantine_to=str(tmp_path / "q"))
    ingest.changes(rows, catalog.open("docs"), 0, "lake")  # died before it was published
    for _ in range(2):
        assert ingest.apply_changes(rows, 0) == 1
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    assert ingest.progress.docs == 2 and ingest.progress.batches == 1 and ingest.progress.completed == {0, 1} and ingest.progress.remaining == 0
    ingest.apply_changes(rows, 1)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_a_failing_batch_is_tried_again(spark, tmp_path):
    """Within the time limit a batch gets through by itself; beyond it the stream fails, commits nothing, and is started again."""
    config, catalog = lake_of(tmp_path, **{"scan.interval.ms": 100}), catalog_of(spark, tmp_path)
    put(spark, config, [("a", "one", "+I", 0, 1, 1)])
    calls = []

    class Shaky(R.Ingest):
        def apply_changes(self, *args, **kw):
            calls.append(1)
            if len(calls) < 4:
                raise OSError("not now")
            return super().apply_changes(*args, **kw)

    q = Shaky(catalog, "docs").start_lake(lake.stream_table(spark, config, "svc"), str(tmp_path / "c"), once=True, timeout_minutes=1)
    q.awaitTermination()
    assert len(calls) == 4 and catalog.open("docs").documents().count() == 1
    calls.clear()
    put(spark, config, [("b", "two", "+I", 0, 2, 2)])
    runner = R.Runner(lambda: Shaky(catalog, "docs").start_lake(lake.stream_table(spark, config, "svc"), str(tmp_path / "c"), 100), delay=0.1)
    runner.start()
    for _ in range(300):
        if catalog.open("docs").documents().count() == 2:
            break
        time.sleep(0.1)
    assert runner.running and runner.restarts == 3
    runner.stop()
    assert not runner.running and catalog.open("docs").version == 2


def test_follow_as_the_settings_say(spark, tmp_path):
    config = lake_of(tmp_path, **{"scan.interval.ms": 100, "field.mapping": {"title": "name"}, "field.drop.prefixes": ["id_"]})
    catalog = catalog_of(spark, tmp_path, Field("id", "_ID"), Field("name", "ATOM"))
    put(spark, config, [("a", "one", "+I", 0, 1, 1)])
    runner = R.follow(spark, catalog, config, "svc", str(tmp_path / "c"))
    runner.start().processAllAvailable()
    runner.stop()
    assert [(r["id"], r["name"]) for r in catalog.open("docs").table().collect()] == [("a", "one")]


def test_renamed_key(spark, tmp_path):
    catalog = catalog_of(spark, tmp_path, Field("key", "_ID"), Field("title", "TEXT"))
    ingest = R.Ingest(catalog, "docs", rename={"id": "key"})
    for n, kind in enumerate(("+I", "-D")):
        ingest.apply_changes(spark.createDataFrame([("a", "t", kind, 0, n, n)], LAKE), n)
    assert catalog.open("docs").documents().count() == 0


def test_topic(spark, tmp_path):
    value = T.StructType.fromDDL("id string, title string, tags array<string>, metadata struct<author:string>")
    config = TopicConfig.read({"topic": "t", "indexName": "docs"})
    catalog = catalog_of(spark, tmp_path, Field("id", "ATOM", search=True), Field("tags", "ATOM", multi=True), Field("metadata_author", "ATOM"))
    rows = [("k", 0, 0, None, ("d1", "x", ["a", None, "b"], ("Alice",))), ("k", 0, 1, None, None), ("k", 1, 0, None, ("d1", "y", [], None))]
    spark.createDataFrame(rows, topic.topic_schema(value)).write.parquet(str(tmp_path / "records"))
    q = R.Ingest(catalog, "docs").start_topic(topic.stream_topic(spark, config, value, folder=str(tmp_path / "records")), str(tmp_path / "c"), once=True)
    q.awaitTermination()
    got = [(r["id"], r["tags"], r["metadata_author"]) for r in catalog.open("docs").table().collect()]
    assert len(got) == 2 and ("d1", ["a", "b"], "Alice") in got  # without an _ID both stay
    assert Q.search(catalog.open("docs"), Q.Term("id", "d1")).total == 2
    if not lake.available(spark, "kafka"):
        with pytest.raises(RuntimeError, match="connector"):
            topic.stream_topic(spark, config, value)


def test_topic_with_ids(spark, tmp_path):
    value = T.StructType.fromDDL("id string, title string")
    rows = [("k", 0, 0, None, ("d1", "old")), ("k", 0, 1, None, ("d1", "new"))]
    catalog = catalog_of(spark, tmp_path)
    R.Ingest(catalog, "docs").apply_records(spark.createDataFrame(rows, topic.topic_schema(value)), 0)
    assert [r["title"] for r in catalog.open("docs").table().collect()] == ["new"]


def test_missing_index_is_tried_again():
    calls, slept = [], []

    def act(fails, error):
        def run():
            calls.append(1)
            if len(calls) <= fails:
                raise error
            return "done"

        return run

    for fails, error, outcome, n in ((1, MissingIndex("i"), "done", 2), (9, MissingIndex("i"), None, 3), (9, ValueError("other"), None, 1), (2, MissingIndex("i"), "done", 3)):
        calls.clear()
        if outcome:
            assert R.retry_missing(act(fails, error), sleep=slept.append) == outcome
        else:
            with pytest.raises(type(error)):
                R.retry_missing(act(fails, error), sleep=slept.append)
        assert len(calls) == n
    assert set(slept) == {5.0}


def test_backoff():
    slept, left = [], iter([1] * 12)

    def act():
        if next(left, None):
            raise OSError
        return 7

    assert R.retry_backoff(act, sleep=slept.append) == 7
    assert slept[:4] == [0.1, 0.2, 0.4, 0.8] and max(slept) == 60.0
    with pytest.raises(ZeroDivisionError):
        R.retry_backoff(lambda: 1 / 0, running=lambda: False, sleep=slept.append)


def test_runner_starts_once(spark, tmp_path):
    config, catalog = lake_of(tmp_path), catalog_of(spark, tmp_path)
    put(spark, config, [("a", "one", "+I", 0, 1, 1)])
    runner = R.Runner(lambda: R.Ingest(catalog, "docs").start_lake(lake.stream_table(spark, config, "svc"), str(tmp_path / "c"), scan_interval_ms=100))
    runner.stop()
    query = runner.start()
    with pytest.raises(RuntimeError):
        runner.start()
    query.processAllAvailable()
    runner.stop()
    assert not runner.running and catalog.open("docs").documents().count() == 1
