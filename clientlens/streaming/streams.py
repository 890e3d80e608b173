"""Structured Streaming: file source, running and windowed aggregates,
watermarks, scoring on the stream, and sinks.

Queries run with a checkpoint under the shared checkpoint folder, so a
restarted driver or a lost executor resumes from the committed offsets and
state. The versioned sink writes micro-batch ``N`` to ``<path>/batch_id=N``
with overwrite: a replayed batch rewrites the same folder, so output is
exactly-once without a transactional table format. ``latest_versions`` turns
the update/complete output log into the final value per key (a shuffle on the
key, never a gather of the whole result).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.errors import AnalysisException

from clientlens.functions.columns import fixed_point_mean
from clientlens.session import scratch_path

BATCH_COL = "batch_id"
#: Files of a micro-batch unless the caller says otherwise. With files of
#: about 1 GB, 100 TB then take about 1,000 micro-batches.
FILES_PER_TRIGGER = 100


def stream_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = FILES_PER_TRIGGER, **options) -> DataFrame:
    """Unbounded DataFrame over files arriving under ``path`` (fixed schema,
    ``max_files_per_trigger`` files per micro-batch)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def event_time(df: DataFrame, ts: str, out: str = "event_time") -> DataFrame:
    """Event-time column usable by ``withWatermark``: TIMESTAMP_NTZ is read as
    a wall clock in the session time zone (UTC on the cluster); a missing
    value falls back to processing time."""
    c = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        c = c.cast("timestamp")
    return df.withColumn(out, F.coalesce(c, F.current_timestamp()))


def stream_group_agg(stream: DataFrame, keys: str | Sequence[str],
                     metrics: dict[str, Column]) -> DataFrame:
    """Running aggregate per key (state: one buffer per key, bounded by the
    number of groups; emit with ``complete`` or ``update``)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return stream.groupBy(*ks).agg(*[c.alias(n) for n, c in metrics.items()])


def windowed_agg(stream: DataFrame, ts: str, metrics: dict[str, Column],
                 window: str, slide: str | None = None, watermark: str | None = "30 seconds",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Sliding (or tumbling) event-time window aggregate, optionally per key.

    With a watermark, windows that end before it are finalised and their
    state evicted, so state stays bounded on an unbounded stream; rows whose
    every window is already closed are dropped as late. The output has
    ``window_start`` / ``window_end`` columns in the input's timestamp type.
    """
    src = stream.withWatermark(ts, watermark) if watermark else stream
    win = F.window(ts, window, slide) if slide else F.window(ts, window)
    agg = src.groupBy(win.alias("window"), *keys).agg(*[c.alias(n) for n, c in metrics.items()])
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *keys, *metrics)


def _mean(value: str, digits: int | None, scale: int | None) -> Column:
    if scale is not None and digits is not None:
        return fixed_point_mean(value, scale, digits)
    return F.avg(value) if digits is None else F.round(F.avg(value), digits)


def stream_sliding(stream: DataFrame, ts: str, value: str, window: str = "1 minute",
                   slide: str = "10 seconds", watermark: str | None = "30 seconds",
                   digits: int | None = 2, scale: int | None = None) -> DataFrame:
    """Event count and mean ``value`` per sliding window (every event lands in
    window/slide windows). ``scale``: see ``fixed_point_mean``."""
    avg = _mean(value, digits, scale)
    return windowed_agg(stream, ts, {"event_count": F.count(F.lit(1)), f"avg_{value}": avg},
                        window, slide, watermark)


def stream_watermark(stream: DataFrame, ts: str, key: str, value: str,
                     window: str = "1 minute", slide: str = "30 seconds",
                     watermark: str = "30 seconds", digits: int | None = 2,
                     scale: int | None = None) -> DataFrame:
    """Watermarked sliding window per key: count and mean ``value``."""
    avg = _mean(value, digits, scale)
    return windowed_agg(stream, ts, {"event_count": F.count(F.lit(1)), f"avg_{value}": avg},
                        window, slide, watermark, keys=[key])


def versioned_batch_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing micro-batch N to ``path/batch_id=N``
    (overwrite, hence idempotent on replay).

    Exactly one action per batch: every action on the batch frame re-runs
    the stateful plan, so an emptiness check before the write would double
    the work; an empty batch simply writes no rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/{BATCH_COL}={batch_id}")
    return write


def nonempty_batches(fn: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Wrap a ``foreachBatch`` function so empty micro-batches are skipped.

    The batch is persisted first: the emptiness check and ``fn`` then share
    one evaluation of the micro-batch plan instead of running it twice.
    """
    def wrapped(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                fn(batch, batch_id)
        finally:
            batch.unpersist()
    return wrapped


def start_stream(df: DataFrame, name: str, output_mode: str = "append",
                 sink: str | Callable[[DataFrame, int], None] = "parquet",
                 path: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None, options: dict | None = None) -> StreamingQuery:
    """Start a named streaming query with an explicit checkpoint.

    ``sink`` is a format name (``parquet``, ``console``, ``memory``...) or a
    ``foreachBatch`` function; ``trigger`` e.g. ``{"processingTime": "5
    seconds"}`` or ``{"availableNow": True}``.
    """
    spark = df.sparkSession
    w = df.writeStream.queryName(name).outputMode(output_mode)
    w = w.option("checkpointLocation", checkpoint or scratch_path(spark, "checkpoints", name))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if callable(sink):
        w = w.foreachBatch(sink)
    else:
        w = w.format(sink)
        if path:
            w = w.option("path", path)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str],
                    schema: T.StructType) -> DataFrame:
    """Final row per key from a versioned output log (the highest batch id
    wins); an empty log gives an empty frame with ``schema``."""
    # the log's schema is known: the stream's output plus the batch_id folder
    # column, so no inference job is needed
    log_schema = T.StructType(schema.fields + [T.StructField(BATCH_COL, T.IntegerType())])
    try:
        log = spark.read.schema(log_schema).format("parquet").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no batch written yet
    # max_by is a hash aggregate with a partial step: no sort, and a key's
    # versions are reduced before the shuffle
    values = [c for c in schema.fieldNames() if c not in keys]
    latest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values]) \
        .select(*schema.fieldNames())


def compact_versions(spark: SparkSession, path: str, keys: Sequence[str],
                     schema: T.StructType, out: str) -> DataFrame:
    """Write the final row per key of a versioned output log to ``out`` (a
    new Parquet table) and return it. A long-running query's log grows by
    one folder per micro-batch; readers can use the compacted table plus
    the batches written after it instead of re-reducing the whole log. The
    log itself is left untouched."""
    latest_versions(spark, path, keys, schema).write.mode("errorifexists").parquet(out)
    return spark.read.parquet(out)


def _finish(q: StreamingQuery, name: str, timeout_s: float | None) -> None:
    """Wait for the query; a timeout stops it and is an error, so a half
    written output is never returned."""
    ended = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
    if timeout_s is not None and not ended:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")


def run_available(df: DataFrame, name: str, keys: Sequence[str],
                  output_mode: str = "update", timeout_s: float | None = None) -> DataFrame:
    """Run a streaming aggregate over all input available now, through the
    versioned sink, and return the final value per key as a batch frame.
    In complete mode the last batch is the whole result, so only its folder
    is read."""
    spark = df.sparkSession
    out = scratch_path(spark, "streams", name)
    written: list[int] = []
    write = versioned_batch_writer(out)

    def tracked(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        written.append(batch_id)

    q = start_stream(df, name, output_mode, tracked,
                     checkpoint=f"{out}-checkpoint", trigger={"availableNow": True})
    _finish(q, name, timeout_s)
    if output_mode == "complete":
        if not written:
            return spark.createDataFrame([], df.schema)
        return spark.read.schema(df.schema).parquet(f"{out}/{BATCH_COL}={max(written)}")
    return latest_versions(spark, out, keys, df.schema)


def run_append(df: DataFrame, name: str, fmt: str = "parquet",
               timeout_s: float | None = None) -> DataFrame:
    """Run a non-aggregating stream into a file sink (exactly-once through the
    sink's commit log) and return what it wrote."""
    spark = df.sparkSession
    out = scratch_path(spark, "streams", name)
    q = start_stream(df, name, "append", fmt, path=out, checkpoint=f"{out}-checkpoint",
                     trigger={"availableNow": True})
    _finish(q, name, timeout_s)
    return spark.read.schema(df.schema).format(fmt).load(out)
