import pytest
from pyspark.sql import functions as F

from tidemark.config import ConfigError, LakeConfig
from tidemark.operators import sharding as S
from tidemark.sources import lake


@pytest.mark.parametrize(("name", "shard"), [("search-photos-23", 23), ("my_service_5", 5), ("service-0", 0), ("service-29", 29), ("a-7-", 7), ("a_+3", 3)])
def test_shard_id(name, shard):
    assert S.shard_id(name, 30) == shard


@pytest.mark.parametrize(("name", "said"), [("my-service-name", "no number"), ("service-30", "outside"), ("service-n5", "no number"), ("--", "no shard"), ("", "no shard"), ("a- 5", "no number")])
def test_bad_shard_id(name, said):
    with pytest.raises(ValueError, match=said):
        S.shard_id(name, 30)


def test_strategies():
    assert isinstance(S.sharding_of(None), S.NoSharding) and isinstance(S.sharding_of({}), S.NoSharding)
    assert isinstance(S.sharding_of({"strategy": "NONE"}), S.NoSharding)
    m = S.sharding_of({"strategy": "Modulo", "modulo": {"max_shards": "30", "partition_field": " p "}})
    assert (m.max_shards, m.partition_field) == (30, "p") and "30 partitions of p" in m.describe()
    assert S.NoSharding().describe() == "No sharding - processing all data"
    with pytest.raises(ConfigError, match="none, geo, modulo"):
        S.sharding_of({"strategy": "hash"})
    with pytest.raises(ConfigError, match="modulo.max_shards"):
        S.sharding_of({"strategy": "modulo", "modulo": {"partition_field": "p"}})
    with pytest.raises(ConfigError, match="modulo.partition_field"):
        S.sharding_of({"strategy": "modulo", "modulo": {"max_shards": 3}})
    for bad in ((0, "p"), (-1, "p"), (3, " "), (3, None)):
        with pytest.raises(ValueError):
            S.ModuloSharding(*bad)
    geo = S.sharding_of({"strategy": "geo"})
    for act in (lambda: geo.validate("t", []), lambda: geo.apply(None, "a-1")):
        with pytest.raises(NotImplementedError):
            act()


def test_validation():
    m = S.ModuloSharding(5, "p")
    m.validate("t", ["p", "q"])
    with pytest.raises(ValueError, match="isn't partitioned"):
        m.validate("t", [])
    with pytest.raises(ValueError, match="q"):
        m.validate("t", ["q"])
    S.NoSharding().validate("t", [])


def test_partition_pruning(spark, tmp_path):
    """Ids 0 to 14 over five shards: shard 2 reads 2, 7 and 12, from its own folder alone."""
    config = LakeConfig.read({
        "database.name": "db", "table.name": "docs", "target.index.name": "i", "warehouse.path": str(tmp_path),
        "sharding": {"strategy": "modulo", "modulo": {"max_shards": 5, "partition_field": "__internal_partition_id"}},
    })
    lake.write_partitioned(spark.range(15), lake.table_path(config), "id", 5)
    assert lake.partition_keys(spark, lake.table_path(config)) == ["__internal_partition_id"]
    part = lake.open_table(spark, config, "test-service-2")
    assert sorted(r["id"] for r in part.select("id").collect()) == [2, 7, 12]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__internal_partition_id" in plan
    assert all("__internal_partition_id=2" in r[0] for r in part.select(F.input_file_name()).distinct().collect())
    with pytest.raises(ValueError):
        lake.open_table(spark, config, "test-service-5")


def test_shard_of(spark):
    row = spark.range(1).select(S.shard_of(F.lit(-7), 5).alias("a"), S.shard_of(F.lit(-7), 5, False).alias("b")).first()
    assert (row["a"], row["b"]) == (3, -2)


def test_missing_formats(spark):
    assert not lake.available(spark, "no_such_format")
