"""Streaming analyses on the ``events`` fixture, run to completion with an
``availableNow`` trigger and read back as batch frames.

The stream reads the events files of the fixture folder (one file, so one
micro-batch here; on a cluster the same query reads a growing folder).
Window means are rounded to 4 digits and summed exactly in cents
(``fixed_point_mean``): windows hold only a few events, so decimal ties such
as 27.72125 are common, and a float mean would round them differently from
engine to engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import streaming as st
from clientlens.functions.columns import fixed_point_mean
from clientlens.session import app_id, scratch_path
from clientlens.sources import read_table


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/events*.parquet"  # every events file in the folder
    schema = read_table(spark, sf_dir, "events").schema  # footer only, no data scan
    return st.stream_source(spark, path, schema, "parquet")


def _as_ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def stream_group_agg(spark, sf_dir):
    agg = st.stream_group_agg(_events_stream(spark, sf_dir), "event_type", {
        "avg_value": fixed_point_mean("value", 2, 2),
        "event_count": F.count(F.lit(1)),
    })
    return st.run_available(agg, "stream_group_agg", ["event_type"], "complete")


def stream_sliding(spark, sf_dir):
    ev = st.event_time(_events_stream(spark, sf_dir), "ts")
    agg = st.stream_sliding(ev, "event_time", "value", "1 minute", "10 seconds",
                            watermark="30 seconds", digits=4, scale=2)
    out = st.run_available(agg, "stream_sliding", ["window_start"], "update")
    return _as_ntz(out, "window_start", "window_end")


def _late_files(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Events in three files that arrive one after the other, a third of the
    time range each; every 20th event of the first third comes with the last
    file, far behind the watermark (which late rows are held against one
    batch after it was reached)."""
    ev = read_table(spark, sf_dir, "events")
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    third = F.when(F.col("ts") < F.lit(low + (high - low) / 3), 1).when(F.col("ts") < F.lit(low + (high - low) * 2 / 3), 2).otherwise(3)
    file = F.when((third == 1) & (F.col("event_id") % 20 == 0), 3).otherwise(third)
    path = scratch_path(spark, "plans", app_id(spark), name, unique=False)
    for k in (1, 2, 3):
        ev.where(file == k).coalesce(1).write.mode("overwrite" if k == 1 else "append").parquet(path)
    return st.stream_source(spark, path, ev.schema, "parquet", max_files_per_trigger=1)


def stream_watermark(spark, sf_dir):
    """Watermarked windows over three micro-batches; windows that have ended
    when the last one comes drop its late rows."""
    ev = st.event_time(_late_files(spark, sf_dir, "late_events"), "ts")
    agg = st.stream_watermark(ev, "event_time", "event_type", "value", "1 minute",
                              "30 seconds", "30 seconds", digits=4, scale=2)
    out = st.run_available(agg, "stream_watermark", ["window_start", "event_type"], "update")
    return _as_ntz(out, "window_start", "window_end")


def stream_missing_time(spark, sf_dir):
    """Events that arrive without a timestamp (every 50th) get the processing
    time: counted by whether their event time is the given one or now."""
    ev = _events_stream(spark, sf_dir)
    gaps = ev.withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    timed = st.event_time(gaps, "ts").withColumn(
        "is_now", F.abs(F.timestamp_diff("SECOND", F.current_timestamp(), F.col("event_time"))) <= 3600)
    agg = st.stream_group_agg(timed, "is_now", {"event_count": F.count(F.lit(1))})
    return st.run_available(agg, "stream_missing_time", ["is_now"], "complete")


def stream_source(spark, sf_dir):
    """The events files read as a stream and passed through to a file sink
    unchanged."""
    return st.run_append(_events_stream(spark, sf_dir), "stream_source")


def stream_state(spark, sf_dir):
    """Windows per event type that are still open after the last batch, read
    from the query's RocksDB state."""
    own = st.rocksdb_session(spark)
    ev = st.event_time(_late_files(own, sf_dir, "late_events_state"), "ts")
    agg = st.windowed_agg(ev, "event_time", {"event_count": F.count(F.lit(1))}, "1 minute", "30 seconds",
                          "30 seconds", keys=["event_type"])
    out = scratch_path(spark, "streams", "stream_state")
    q = st.start_stream(agg, "stream_state", "update", st.versioned_batch_writer(out),
                        checkpoint=f"{out}-checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    rows = st.open_windows(spark, f"{out}-checkpoint")
    count = rows.schema["value"].dataType.fieldNames()[0]
    rows = rows.select("window_start", "window_end", "event_type", F.col(f"value.`{count}`").alias("event_count"))
    return _as_ntz(rows, "window_start", "window_end")


def stream_upsert(spark, sf_dir):
    """The newest event of each user over three micro-batches, the last of
    which brings events of the first third late."""
    ev = _late_files(spark, sf_dir, "late_events_upsert")
    out = scratch_path(spark, "streams", "stream_upsert")
    keys, order = ["user_id"], ["ts", "event_id"]
    q = st.start_stream(ev, "stream_upsert", "append", st.upsert_writer(out, keys, order),
                        checkpoint=f"{out}-checkpoint", trigger={"availableNow": True})
    q.awaitTermination()
    return st.upserted(spark, out, keys, order, ev.schema)


def stream_memory(spark, sf_dir):
    """Running counts in a memory table, read by SQL (a row per event type)."""
    agg = st.stream_group_agg(_events_stream(spark, sf_dir), "event_type", {"event_count": F.count(F.lit(1))})
    name = "stream_memory_" + uuid.uuid4().hex[:12]
    st.start_stream(agg, name, "complete", "memory", trigger={"availableNow": True}).awaitTermination()
    return spark.sql(f"SELECT event_type, event_count FROM {name}")


def stream_concurrent(spark, sf_dir):
    """The job's named queries side by side over the events until all that has
    arrived is in, then stopped: events counted by each (a sliding window
    counts an event once a window)."""
    ev = _events_stream(spark, sf_dir).select(
        F.col("event_type").alias("job"), F.col("value").alias("balance"), F.col("value").alias("duration"),
        F.col("ts").alias("event_time"))
    root = scratch_path(spark, "streams", "stream_concurrent")
    counted = {"job_aggregation": ("transaction_count", ["job"]), "window_analysis": ("event_count", ["window_start"]),
               "watermark_query": ("event_count", ["window_start", "job"])}
    running = st.start_contact_streams(ev, root)
    try:
        for q in running.values():
            q.processAllAvailable()
    finally:
        for q in running.values():
            q.stop()
    out = None
    for name, (count, keys) in counted.items():
        # the newest batch of a key; a running total's newest batch is all of it
        log = spark.read.option("mergeSchema", False).parquet(f"{root}/{name}")
        last = log.groupBy(*keys).agg(F.max_by(count, st.streams.BATCH_COL).alias("n"))
        row = last.agg(F.sum("n").alias("events")).select(F.lit(name).alias("query"), "events", F.lit(not running[name].isActive).alias("stopped"))
        out = row if out is None else out.unionByName(row)
    return out


def stream_feed(spark, sf_dir):
    """Suppliers replayed 50 rows a micro-batch in the order of their key."""
    su = read_table(spark, sf_dir, "supplier")
    return st.run_feed(su, "stream_feed", ["s_suppkey"], 50)


QUERIES = {
    "stream_source": stream_source,
    "stream_group_agg": stream_group_agg,
    "stream_sliding": stream_sliding,
    "stream_watermark": stream_watermark,
    "stream_missing_time": stream_missing_time,
    "stream_state": stream_state,
    "stream_upsert": stream_upsert,
    "stream_feed": stream_feed,
    "stream_memory": stream_memory,
    "stream_concurrent": stream_concurrent,
}
