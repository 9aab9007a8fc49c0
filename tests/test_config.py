import pytest

from tidemark import config as C

LAKE = {"database.name": "test_db", "table.name": "test_table", "target.index.name": "idx", "warehouse.path": "/w"}


def test_lookup():
    nested = {"a": {"b": {"c": 1}}, "x": "y"}
    assert C.lookup(nested, "a.b.c") == 1
    assert C.lookup(nested, "a.q.c") is None
    assert C.lookup(nested, "") is None and C.lookup(None, "a") is None and C.lookup(nested, None) is None
    with pytest.raises(C.ConfigError):
        C.lookup(nested, "x.y")


def test_getters():
    c = {"n": "12", "bad": "12x", "m": {"k": 1}, "s": 5}
    assert C.get_integer(c, "n") == 12 and C.get_integer(c, "s") == 5
    assert C.get_integer(c, "bad", 7) == 7 and C.get_integer(c, "none", None) is None
    for path in ("bad", "none"):
        with pytest.raises(C.ConfigError):
            C.get_integer(c, path)
    assert C.get_string(c, "s") == "5" and C.get_string(c, "none", "d") == "d" and C.get_string(c, "s.t", "d") == "d"
    with pytest.raises(C.ConfigError):
        C.get_string(c, "none")
    assert C.get_map(c, "m") == {"k": 1} and C.get_map(c, "none") is None
    with pytest.raises(C.ConfigError):
        C.get_map(c, "n")


def test_lake_config():
    c = C.LakeConfig.read(LAKE)
    assert c.path == "test_db.test_table"
    assert (c.workers, c.batch_size, c.poll_timeout_ms, c.scan_interval_ms, c.queue_capacity, c.checkpoint_timeout_minutes) == (4, 1000, 1000, 30000, 10000, 10)
    assert not c.rename and not c.drop_prefixes and not c.sharding
    c = C.LakeConfig.read(LAKE | {"worker.threads": "8", "batch.size": "2000", "queue.capacity": "many"})
    assert (c.workers, c.batch_size, c.queue_capacity) == (8, 2000, 10000)
    nested = {"database": {"name": "a.b.data"}, "table": {"name": "reviews"}, "target": {"index": {"name": "i"}}, "warehouse": {"path": "/w"}, "sharding": {"strategy": "none"}}
    c = C.LakeConfig.read(nested)
    assert c.path == "a.b.data.reviews" and c.sharding == {"strategy": "none"}
    for key in LAKE:
        with pytest.raises(C.ConfigError, match=key):
            C.LakeConfig.read({k: v for k, v in LAKE.items() if k != key})


def test_topic_config():
    c = C.TopicConfig.read({"topic": "t", "indexName": "i"})
    assert (c.servers, c.offset_reset, c.batch_size) == ("localhost:9092", "earliest", 1000)
    said = set()
    for change in ({"topic": ""}, {"indexName": ""}, {"bootstrapServers": ""}):
        with pytest.raises(C.ConfigError) as e:
            C.TopicConfig.read({"topic": "t", "indexName": "i"} | change)
        said.add(str(e.value))
    assert len(said) == 3
    late = C.TopicConfig.read({"topic": "t", "indexName": "i", "batchSize": "x", "autoCommitEnabled": True})
    with pytest.raises(C.ConfigError):
        late.batch_size


def test_s3a():
    assert C.s3a_options("file:///w", {"endpoint": "http://x"}) == {}
    plain = C.s3a_options("s3a://b/w")
    assert plain["fs.s3a.connection.maximum"] == "256" and plain["fs.s3a.aws.credentials.provider"] == C.DEFAULT_CHAIN
    local = C.s3a_options("s3a://b/w", {"endpoint": "http://x", "s3-access-key": "a", "s3-secret-key": "b", "path.style.access": "true"})
    assert local["fs.s3a.path.style.access"] == "true" and local["fs.s3a.aws.credentials.provider"] == C.STATIC_KEYS
    assert "fs.s3a.path.style.access" not in C.s3a_options("s3a://b", {"endpoint": "e", "s3-access-key": "a", "s3-secret-key": "b", "path.style.access": "false"})
    with pytest.raises(C.ConfigError):
        C.s3a_options("s3a://b", {"endpoint": "e"})
    assert "spark.hadoop.fs.s3a.threads.max" in C.spark_options("s3a://b")
