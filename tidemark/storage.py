"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset and Spark runs in one process (tests) a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark.sparkContext, "_tidemark_dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        made = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        base = spark.sparkContext._tidemark_dir = f"file://{made}"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that nothing has used; all of an application's lie in one folder, which may go when it has ended."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: lineage ends there, and a lost executor costs no recomputation."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a side may have to be broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def narrow(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side marked for broadcast if it is short, else as it is. Counting it should cost little: save it first."""
    return F.broadcast(side) if side.count() <= most else side


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path through Hadoop's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
