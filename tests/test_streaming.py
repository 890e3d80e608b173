import datetime as dt
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientlens import streaming as st
from clientlens.session import scratch_path

LATE_SCHEMA = T.StructType([T.StructField("event_time", T.TimestampType()),
                            T.StructField("job", T.StringType()),
                            T.StructField("balance", T.IntegerType())])


def _write_files(folder, rows):
    """One CSV file per row, modification times 2 s apart (file order)."""
    os.makedirs(folder)
    base = time.time() - 100
    for i, (ts, job, bal) in enumerate(rows):
        p = os.path.join(folder, f"f{i:02d}.csv")
        with open(p, "w") as f:
            f.write(f"{ts},{job},{bal}\n")
        os.utime(p, (base + 2 * i, base + 2 * i))


def test_late_data_golden(spark, tmp_dir):
    """Window 1 min / 30 s, watermark 30 s, one event per micro-batch."""
    day = "2024-01-01"
    times = ["00:00:05", "00:05:00", "00:05:10", "00:00:10", "00:04:05", "00:05:20"]
    folder = os.path.join(tmp_dir, "late")
    _write_files(folder, [(f"{day} {t}", "admin.", 100) for t in times])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv", max_files_per_trigger=1)
    agg = st.stream_watermark(stream, "event_time", "job", "balance")
    out = scratch_path(spark, "test", "late")
    q = st.start_stream(agg, "late_golden", "update", st.versioned_batch_writer(out),
                        checkpoint=out + "-ckpt", trigger={"availableNow": True})
    q.awaitTermination(120)
    data = [p for p in q.recentProgress if p["numInputRows"] > 0]
    state = [p["stateOperators"][0]["numRowsTotal"] for p in data]
    dropped = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in data]
    assert state == [2, 4, 2, 2, 3, 3]
    assert dropped == [0, 0, 0, 2, 1, 0]
    final = st.latest_versions(spark, out, ["window_start", "job"], agg.schema)
    counts = {r["window_start"].strftime("%H:%M:%S"): r["event_count"] for r in final.collect()}
    # 00:04:05 is 65 s late yet counted in 04:00-05:00, which was still open;
    # 00:00:10 is dropped from both of its windows
    assert counts == {"23:59:30": 1, "00:00:00": 1, "00:04:00": 1,
                      "00:04:30": 3, "00:05:00": 3}


def test_stream_equals_batch(spark, tmp_dir):
    rows = [(f"2024-01-01 00:0{i}:00", job, bal) for i, (job, bal) in
            enumerate([("a", 1), ("b", 2), ("a", 3), ("b", 5), ("c", 8)])]
    folder = os.path.join(tmp_dir, "eq")
    _write_files(folder, rows)
    metrics = {"avg_balance": F.round(F.avg("balance"), 2), "n": F.count(F.lit(1))}
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv", max_files_per_trigger=2)
    got = st.run_available(st.stream_group_agg(stream, "job", metrics), "eq_stream", ["job"],
                           "complete")
    batch = spark.read.schema(LATE_SCHEMA).csv(folder).groupBy("job").agg(
        *[c.alias(n) for n, c in metrics.items()])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_sliding_window_membership(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "slide")
    _write_files(folder, [("2024-01-01 00:00:15", "a", 10)])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv")
    agg = st.stream_sliding(stream, "event_time", "balance", "1 minute", "10 seconds")
    got = st.run_available(agg, "slide_one", ["window_start"])
    starts = sorted(r["window_start"] for r in got.collect())
    assert len(starts) == 6  # one event lands in window / slide windows
    assert starts[0] == dt.datetime(2023, 12, 31, 23, 59, 20) or starts[0].minute == 59


def test_empty_stream_gives_empty_result(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "empty")
    os.makedirs(folder)
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv")
    agg = st.stream_group_agg(stream, "job", {"n": F.count(F.lit(1))})
    got = st.run_available(agg, "empty", ["job"], "complete")
    assert got.count() == 0 and got.columns == ["job", "n"]


def test_event_time_from_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 5),)], "ts timestamp_ntz")
    out = st.event_time(df, "ts")
    assert out.schema["event_time"].dataType == T.TimestampType()


def test_missing_event_time_column_defaults_to_now(spark, tmp_dir):
    from clientlens.schema import stream_schema
    folder = os.path.join(tmp_dir, "noet")
    os.makedirs(folder)
    with open(os.path.join(folder, "c1.csv"), "w") as f:
        f.write("35,admin.,married,secondary,no,1200,yes,no,cellular,5,may,120,1,-1,0,unknown,no\n")
    stream = st.stream_source(spark, folder, stream_schema(), "csv")
    with_ts = st.event_time(stream, "event_time")
    got = st.run_append(with_ts.select("job", "event_time"), "noet")
    rows = got.collect()
    assert len(rows) == 1 and rows[0]["event_time"] is not None


def test_memory_sink_and_concurrent_queries(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "conc")
    _write_files(folder, [("2024-01-01 00:00:01", "a", 1), ("2024-01-01 00:00:02", "b", 2)])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv")
    q1 = st.start_stream(st.stream_group_agg(stream, "job", {"n": F.count(F.lit(1))}),
                         "job_counts_mem", "complete", "memory", trigger={"availableNow": True})
    seen = []
    q2 = st.start_stream(stream, "batches_cb", "append",
                         st.nonempty_batches(lambda b, i: seen.append((i, b.count()))),
                         trigger={"availableNow": True})
    for q in (q1, q2):
        q.awaitTermination(120)
    rows = spark.sql("SELECT * FROM job_counts_mem ORDER BY job").collect()
    assert [(r["job"], r["n"]) for r in rows] == [("a", 1), ("b", 1)]
    assert sum(n for _, n in seen) == 2 and all(n > 0 for _, n in seen)
    q1.stop()


def test_restart_from_checkpoint_is_exactly_once(spark, tmp_dir):
    """A second run on the same checkpoint and sink continues where the
    first stopped: new files only, no duplicated or lost output."""
    folder = os.path.join(tmp_dir, "restart")
    _write_files(folder, [(f"2024-01-01 00:00:0{i}", "a", i) for i in range(3)])
    out, ckpt = os.path.join(tmp_dir, "restart-out"), os.path.join(tmp_dir, "restart-ckpt")

    def run():
        stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv")
        agg = st.stream_group_agg(stream, "job", {"n": F.count(F.lit(1)),
                                                  "total": F.sum("balance")})
        q = st.start_stream(agg, "restart_q", "complete", st.versioned_batch_writer(out),
                            checkpoint=ckpt, trigger={"availableNow": True})
        q.awaitTermination(120)
        return st.latest_versions(spark, out, ["job"], agg.schema).collect()

    assert [(r["job"], r["n"], r["total"]) for r in run()] == [("a", 3, 3)]
    base = time.time()
    for i, bal in enumerate([10, 20]):  # two more files arrive later
        p = os.path.join(folder, f"late{i}.csv")
        with open(p, "w") as f:
            f.write(f"2024-01-01 00:01:0{i},a,{bal}\n")
        os.utime(p, (base + i, base + i))
    assert [(r["job"], r["n"], r["total"]) for r in run()] == [("a", 5, 33)]


def test_replayed_batch_overwrites(spark, tmp_dir):
    out = os.path.join(tmp_dir, "replay")
    write = st.versioned_batch_writer(out)
    batch = spark.createDataFrame([("a", 1)], "job string, n long")
    write(batch, 0)
    write(batch, 0)  # the same micro-batch re-executed after a failure
    assert spark.read.parquet(out).count() == 1


def test_append_mode_emits_only_closed_windows(spark, tmp_dir):
    """Same six late-data files in append mode: only the windows the
    watermark closed are written (the two windows of 00:00:05)."""
    day = "2024-01-01"
    times = ["00:00:05", "00:05:00", "00:05:10", "00:00:10", "00:04:05", "00:05:20"]
    folder = os.path.join(tmp_dir, "late_append")
    _write_files(folder, [(f"{day} {t}", "admin.", 100) for t in times])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv", max_files_per_trigger=1)
    agg = st.stream_watermark(stream, "event_time", "job", "balance")
    rows = st.run_append(agg, "late_append").collect()
    assert sorted((r["window_start"].strftime("%H:%M:%S"), r["event_count"]) for r in rows) == \
        [("00:00:00", 1), ("23:59:30", 1)]


def test_contact_streams_four_queries(spark, tmp_dir):
    """The four queries of the streaming job on one client-chunk source
    (files without event_time: it falls back to processing time)."""
    from clientlens import ml
    from clientlens.schema import CATEGORICAL_COLS, NUMERIC_COLS, client_schema, stream_schema
    from test_sql_equivalence import _client

    clients = spark.createDataFrame([_client(i) for i in range(300)], client_schema())
    model, _ = ml.train_rf(clients, CATEGORICAL_COLS, NUMERIC_COLS, "y", num_trees=5, max_depth=3)
    folder = os.path.join(tmp_dir, "chunks")
    clients.repartition(3).write.option("header", False).csv(folder)  # 3 chunk files
    stream = st.stream_source(spark, folder, stream_schema(), "csv")
    root = os.path.join(tmp_dir, "job")
    qs = st.start_contact_streams(stream, root, model, trigger={"availableNow": True})
    assert set(qs) == {"job_aggregation", "ml_predictions", "window_analysis", "watermark_query"}
    for q in qs.values():
        q.awaitTermination(180)
        assert q.exception() is None
    jobs = spark.read.parquet(os.path.join(root, "job_aggregation"))
    final = st.latest_versions(spark, os.path.join(root, "job_aggregation"), ["job"],
                               jobs.drop("batch_id").schema)
    assert final.agg(F.sum("transaction_count")).collect()[0][0] == 300
    preds = spark.read.parquet(os.path.join(root, "ml_predictions"))
    assert preds.count() == 300 and set(preds.columns) >= {"prediction", "confidence"}
    windows = spark.read.parquet(os.path.join(root, "window_analysis"))
    assert windows.count() > 0


def test_compact_versions(spark, tmp_dir):
    out = os.path.join(tmp_dir, "log")
    write = st.versioned_batch_writer(out)
    write(spark.createDataFrame([("a", 1), ("b", 1)], "job string, n long"), 0)
    write(spark.createDataFrame([("a", 3)], "job string, n long"), 1)
    schema = spark.createDataFrame([], "job string, n long").schema
    compact = st.compact_versions(spark, out, ["job"], schema, os.path.join(tmp_dir, "compact"))
    assert sorted(map(tuple, compact.collect())) == [("a", 3), ("b", 1)]


def test_console_sink_processing_time_trigger_and_stop(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "console")
    _write_files(folder, [("2024-01-01 00:00:01", "a", 1)])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv")
    agg = st.stream_group_agg(stream, "job", {"n": F.count(F.lit(1))})
    q = st.start_stream(agg, "console_q", "complete", "console",
                        trigger={"processingTime": "1 second"}, options={"truncate": False})
    q.processAllAvailable()
    assert q.isActive and q.lastProgress["numInputRows"] >= 0
    q.stop()
    assert not q.isActive


def test_timeout_is_an_error_and_stops_the_query(spark, tmp_dir):
    import pytest
    folder = os.path.join(tmp_dir, "slow")
    _write_files(folder, [(f"2024-01-01 00:0{i}:00", "a", 1) for i in range(5)])
    stream = st.stream_source(spark, folder, LATE_SCHEMA, "csv", max_files_per_trigger=1)
    slow = st.stream_group_agg(stream, "job", {"n": F.count(F.lit(1))})
    with pytest.raises(TimeoutError):
        st.run_available(slow, "slow_stream", ["job"], "complete", timeout_s=0.01)
    assert not [q for q in spark.streams.active if q.name == "slow_stream"]
