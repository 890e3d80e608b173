"""What a stateful query holds after its last batch, read from its checkpoint
with the state data source (one task per state partition, on the cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in
    RocksDB (on the executors' disks, changes in the checkpoint folder)
    instead of on the heap. The given session's settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(key, value, partition_id) of a stateful operator after the last
    committed batch."""
    return spark.read.format("statestore").option("operatorId", operator).load(checkpoint)


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator: its id, name, state stores, partitions
    and the batches that its state can be read for."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, window: str = "window", operator: int = 0) -> DataFrame:
    """Windows that the watermark has not closed yet: ``window_start``,
    ``window_end``, the other key columns, and the aggregation buffers as
    ``value``."""
    rows = state_rows(spark, checkpoint, operator)
    others = [f.name for f in rows.schema["key"].dataType.fields if f.name != window]
    at = F.col(f"key.`{window}`")
    return rows.select(at["start"].alias("window_start"), at["end"].alias("window_end"),
                       *[F.col(f"key.`{c}`").alias(c) for c in others], "value")
