"""Topics of records: a broker where its connector is installed, and for tests and replays a folder of Parquet or JSON files.

Records come as key, value (a struct), partition, offset and timestamp. Values that can't be decoded are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import TopicConfig
from .lake import available

#: Records of a partition that a micro-batch takes.
PER_POLL = 1000
#: A magic byte and the number of a schema stand before each record of a schema registry.
FRAME_HEAD = 5


def topic_schema(value: T.StructType) -> T.StructType:
    return T.StructType.fromDDL("key string, partition int, offset long, timestamp timestamp").add("value", value)


def stream_topic(spark: SparkSession, config: TopicConfig, value: T.StructType, partitions: int = 1, folder: str | None = None, avro_schema: str | None = None) -> DataFrame:
    """A topic's records as a stream. ``folder`` stands in for a broker: its Parquet files hold topic_schema(value)."""
    if folder is not None:
        return spark.readStream.schema(topic_schema(value)).option("maxFilesPerTrigger", 1).parquet(folder)
    if not available(spark, "kafka"):
        raise RuntimeError("no topic connector is installed; pass a folder of records")
    if avro_schema is None:
        raise ValueError("records of a broker need their Avro schema")
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", config.servers)
        .option("kafka.group.id", config.group)
        .option("subscribe", config.topic)
        .option("startingOffsets", config.offset_reset)
        .option("maxOffsetsPerTrigger", PER_POLL * partitions)
        .load()
    )
    return raw.select(F.col("key").cast("string"), "partition", "offset", "timestamp", decoded(F.col("value"), avro_schema).alias("value"))


def decoded(value: Column, avro_schema: str) -> Column:
    """A framed record as a struct, null where it can't be read."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(F.substring(value, FRAME_HEAD + 1, 2**31 - 1 - FRAME_HEAD), avro_schema, {"mode": "PERMISSIVE"})


def records(rows: DataFrame) -> DataFrame:
    """The values that are records, as columns; others (also null ones) are passed over."""
    return rows.where("value is not null").select("value.*")
