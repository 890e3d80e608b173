"""A stream that replays a table, so many rows a micro-batch, in a fixed order.

Micro-batch N of the ``rate-micro-batch`` source holds the numbers from N times
the rows per batch on; joined to the table's row numbers they are its rows. The
same batch has the same rows in every run, without staged files.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens.session import ensure_checkpoint_dir, scratch_path
from clientlens.streaming.streams import start_stream

ROW = "__row"
INTERVAL = "spark.sql.streaming.fileSink.log.compactInterval"
#: Settings of the feed's own session. A micro-batch is so small that what it
#: costs is its bookkeeping: one exchange of a batch's numbers is nothing to
#: re-plan, and the sink's log, which nobody reads before the end, is folded
#: (each time as a whole) and listed less often.
FEED_CONF = {
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.ui.explainMode": "simple",
    INTERVAL: "100",
    "spark.sql.streaming.fileSink.log.cleanupDelay": "1s",
}
#: On a local file system each rename through Hadoop's FileContext starts
#: processes (``readlink``), for every log entry of every batch; a FileSystem
#: renames by itself. Elsewhere Spark's choice stays.
LOCAL_LOG = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def feed_session(spark: SparkSession, root: str) -> SparkSession:
    """A session of the same application for a feed that keeps its logs under
    ``root``. The given session's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for key, value in FEED_CONF.items():
        own.conf.set(key, value)
    if urlsplit(root).scheme in ("", "file"):
        own.conf.set("spark.sql.streaming.checkpointFileManagerClass", LOCAL_LOG)
    return own


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with its row number from 0 in ``__row``, in the order of the
    given columns, then of all others (rows that are equal in all may swap).
    A distributed sort; the driver gets one count per sorted partition."""
    ensure_checkpoint_dir(df.sparkSession)
    rest = [c for c in df.columns if c not in order]
    placed = df.orderBy(*order, *rest).withColumn("__at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__at", 33)
    before, total = [], 0
    for r in sorted(placed.groupBy(part.alias("part")).count().collect()):
        before.append((r["part"], total))
        total += r["count"]
    offsets = df.sparkSession.createDataFrame(before, "__part long, __before long")
    return placed.join(offsets, part == F.col("__part")).select(
        *df.columns, (F.col("__before") + F.col("__at") - F.shiftleft("__part", 33)).alias(ROW))


def feed(spark: SparkSession, table: DataFrame, rows_per_batch: int) -> DataFrame:
    """Stream over a ``numbered`` table, ``rows_per_batch`` rows a micro-batch
    (the last one has the rest; later ones are empty)."""
    ticks = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
             .option("numPartitions", max(1, rows_per_batch // 1_000_000)).load().select(F.col("value").alias(ROW)))
    return table.join(F.broadcast(ticks), ROW)  # one batch of numbers: rows_per_batch rows


def _sink_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What the feed's sink has committed. Its log is read here, once, and must
    be read with the interval it was written with."""
    before = spark.conf.get(INTERVAL, None)
    spark.conf.set(INTERVAL, FEED_CONF[INTERVAL])
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.unset(INTERVAL) if before is None else spark.conf.set(INTERVAL, before)


def run_feed(df: DataFrame, name: str, order: Sequence[str], rows_per_batch: int,
             timeout_s: float = 3600) -> DataFrame:
    """Replay the whole of ``df`` through a file sink and return what it wrote:
    every row once, with the micro-batch it came in as ``batch``. Ends after
    the batch with the last row; no rows: no batch. ``timeout_s`` bounds the wait
    for the next batch, not that for all: their number follows the table."""
    spark = df.sparkSession
    root = scratch_path(spark, "streams", name)
    own = feed_session(spark, root)
    numbered(df, order).write.parquet(f"{root}/table")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    # kept in columns by the executors: a batch opens no file of the table
    table = own.read.schema(f"{schema}, {ROW} long").parquet(f"{root}/table").persist()
    total = table.count()
    batches = -(-total // rows_per_batch)
    out = feed(own, table, rows_per_batch).select(
        *df.columns, F.floor(F.col(ROW) / rows_per_batch).alias("batch"))
    if batches:
        q = start_stream(out, name, "append", "parquet", path=f"{root}/out",
                         checkpoint=f"{root}/checkpoint", trigger={"processingTime": "0 seconds"})
        done, deadline = -1, time.monotonic() + timeout_s
        try:
            while done < batches - 1:
                if q.exception() is not None:
                    raise RuntimeError(f"stream {name} failed: {q.exception()}")
                progress = q.lastProgress
                if progress and progress.batchId > done:
                    done, deadline = progress.batchId, time.monotonic() + timeout_s
                elif time.monotonic() > deadline:
                    raise TimeoutError(f"stream {name}: no batch after {done} within {timeout_s} s")
                else:
                    time.sleep(0.2)
        finally:
            q.stop()
            table.unpersist()
        return _sink_rows(spark, f"{root}/out", out.schema)
    return spark.createDataFrame([], out.schema)
