"""Lake tables: Parquet folders below a warehouse, read whole, as a stream of new files, or one shard of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..config import LakeConfig, s3a_options
from ..operators.sharding import sharding_of


def table_path(config: LakeConfig) -> str:
    return f"{config.warehouse.rstrip('/')}/{config.database}.db/{config.table}"


def configure(spark: SparkSession, config: LakeConfig) -> None:
    """Puts the warehouse's S3A settings into Hadoop's configuration."""
    for k, v in s3a_options(config.warehouse, config.s3).items():
        spark._jsc.hadoopConfiguration().set(k, v)


def partition_keys(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a folder, by its first level's names and those below."""
    jvm = spark._jvm.org.apache.hadoop.fs
    here, keys = jvm.Path(path), []
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    while True:
        below = [s.getPath() for s in fs.listStatus(here) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return keys
        keys.append(below[0].getName().split("=")[0])
        here = below[0]


def open_table(spark: SparkSession, config: LakeConfig, service: str) -> DataFrame:
    """The part of the table that a service reads; a table that its sharding can't read is refused."""
    configure(spark, config)
    path, strategy = table_path(config), sharding_of(config.sharding)
    strategy.validate(config.path, partition_keys(spark, path))
    return strategy.apply(spark.read.parquet(path), service)


def stream_table(spark: SparkSession, config: LakeConfig, service: str, schema: T.StructType | None = None, files: int | None = None) -> DataFrame:
    """All files that are there, then those that come: what a checkpoint has seen is not read again."""
    configure(spark, config)
    path, strategy = table_path(config), sharding_of(config.sharding)
    strategy.validate(config.path, partition_keys(spark, path))
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    return strategy.apply(reader.option("maxFilesPerTrigger", files or config.queue_capacity).parquet(path), service)


def write_partitioned(rows: DataFrame, path: str, key: str, shards: int, field: str = "__internal_partition_id") -> None:
    """Writes a table that modulo sharding can read: a folder for each shard."""
    from ..operators.sharding import shard_of

    rows.withColumn(field, shard_of(rows[key], shards)).write.mode("append").partitionBy(field).parquet(path)


def available(spark: SparkSession, name: str) -> bool:
    """Whether a data source is installed."""
    try:
        spark.read.format(name).schema("a int").load()
    except Exception as e:  # each version of Spark has its own class for this
        return "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find" not in str(e) and "deploying" not in str(e)
    return True
