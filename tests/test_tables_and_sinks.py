"""Persisted partitioning, metrics beside a write, upserts, open state, the
replaying feeder and shared scans."""
import pytest
from pyspark.sql import functions as F

from clientlens import operators as ops
from clientlens import streaming as st
from clientlens.plans import registry
from clientlens.session import scratch_path
from clientlens.sources import append_bucketed, batch_metrics, observe_stream, observed_write, table_metrics

from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_table_groups_and_joins_without_exchange(spark, tmp_dir):
    rows = [(i % 7 if i % 3 else None, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long")
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        append_bucketed(df.where("v < 2000"), name, ["k"], 4, files_per_bucket=3, path=f"{tmp_dir}/{name}")
        append_bucketed(df.where("v >= 2000"), name, ["k"], 4, files_per_bucket=3, path=f"{tmp_dir}/{name}")
    t, u = spark.table("bucketed_a"), spark.table("bucketed_b")
    assert sorted(map(tuple, t.collect()), key=str) == sorted(rows, key=str)
    grouped = t.groupBy("k").agg(F.count("*").alias("n"))
    assert "Exchange" not in plan_of(grouped)
    assert {r.k: r.n for r in grouped.collect()} == {k: sum(a == k for a, _ in rows) for k in {a for a, _ in rows}}
    assert "Exchange" not in plan_of(t.hint("merge").join(u.groupBy("k").agg(F.max("v")), "k"))
    with pytest.raises(Exception, match="(?i)bucket"):
        append_bucketed(df, "bucketed_a", ["k"], 8, path=f"{tmp_dir}/bucketed_a")
    assert append_bucketed(df.where("false"), "bucketed_a", ["k"], 4, path=f"{tmp_dir}/bucketed_a").count() == 3000


def test_hot_bucket_is_several_files(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS bucketed_hot")
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    t = append_bucketed(df, "bucketed_hot", ["k"], 4, files_per_bucket=5, path=f"{tmp_dir}/hot")
    assert len(t.inputFiles()) == 5


def test_registered_bucketed_group_has_no_exchange(spark):
    assert "Exchange" not in plan_of(registry.queries()["bucketed_group"](spark, SF_SMALL))


def test_observed_write(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a.b int, c string".replace("a.b", "`a.b`"))
    seen = observed_write(df, f"{tmp_dir}/o", table_metrics(df, {"mean": F.avg("`a.b`")}))
    assert seen == {"row_count": 3, "null_a.b": 1, "null_c": 2, "mean": 1.5}
    assert spark.read.parquet(f"{tmp_dir}/o").count() == 3
    empty = df.where("false")
    assert observed_write(empty, f"{tmp_dir}/e", table_metrics(empty, {"mean": F.avg("`a.b`")}))["mean"] is None


def test_stream_metrics_per_batch(spark, tmp_dir):
    for i in range(3):
        spark.range(i + 1).write.mode("append").parquet(f"{tmp_dir}/in")
    src = spark.readStream.schema("id long").option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/in")
    q = st.start_stream(observe_stream(src, "m", {"n": F.count("*")}), "observed", "append", "parquet",
                        path=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    assert sum(r["n"] for r in batch_metrics(q, "m").values()) == 6


def test_upserts_survive_replay_late_rows_and_compaction(spark, tmp_dir):
    schema = "k string, t long, v string"
    batches = [[("a", 1, "x"), ("a", 3, "z"), (None, 1, "n")], [], [("a", 2, "late"), ("b", None, "p"), ("b", 0, "q")],
               [(None, 1, "m"), ("c", 5, None), ("c", 5, "t")]]
    want = {("a", 3, "z"), (None, 1, "n"), ("b", 0, "q"), ("c", 5, "t")}
    kind = spark.createDataFrame([], schema).schema
    path, keys, order = f"{tmp_dir}/log", ["k"], ["t"]
    assert st.upserted(spark, path, keys, order, kind).collect() == []
    write = st.upsert_writer(path, keys, order)
    for n, rows in [*enumerate(batches), (0, batches[0]), (2, batches[2])]:
        write(spark.createDataFrame(rows, schema), n)
    assert set(map(tuple, st.upserted(spark, path, keys, order, kind).collect())) == want
    assert {r.batch_id for r in spark.read.parquet(path).select("batch_id").distinct().collect()} == {0, 2, 3}
    st.compact_upserts(spark, path, keys, order, kind, f"{tmp_dir}/base", through=2)
    both = st.upserted(spark, path, keys, order, kind, base=f"{tmp_dir}/base", after=2)
    assert set(map(tuple, both.collect())) == want


def test_state_operators_and_provider(spark):
    own = st.rocksdb_session(spark)
    assert "RocksDB" in own.conf.get("spark.sql.streaming.stateStore.providerClass")
    path = scratch_path(spark, "tests", "state")
    spark.createDataFrame([("2026-01-01 00:00:10", "a"), ("2026-01-01 00:05:00", None)], "t string, k string") \
        .select(F.col("t").cast("timestamp").alias("t"), "k").write.parquet(f"{path}/in")
    src = own.readStream.schema("t timestamp, k string").parquet(f"{path}/in")
    agg = st.windowed_agg(src, "t", {"n": F.count("*")}, "1 minute", watermark="30 seconds", keys=["k"])
    q = st.start_stream(agg, "state_test", "update", "memory", checkpoint=f"{path}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    assert st.state_operators(spark, f"{path}/ck").count() == 1
    left = st.open_windows(spark, f"{path}/ck").collect()
    assert [(str(r.window_start), r.k) for r in left] == [("2026-01-01 00:05:00", None)]


def test_feeder_gives_every_row_once_in_order(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"v{i % 3}") for i in range(101)] + [(None, None)], "a long, b string").repartition(5)
    got = st.run_feed(df, "feeder_test", ["a"], 25).collect()
    order = sorted(((r.a, r.b) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((r.batch, str(r.a), str(r.b)) for r in got) == sorted((i // 25, str(a), str(b)) for i, (a, b) in enumerate(order))
    assert st.run_feed(df.where("false"), "feeder_empty", ["a"], 25).collect() == []


def test_feeder_waits_for_each_batch_not_for_all(spark):
    df = spark.range(120).toDF("a")
    got = st.run_feed(df, "feeder_long", ["a"], 1, timeout_s=12)  # all 120 take longer
    assert sorted((r.a, r.batch) for r in got.collect()) == [(i, i) for i in range(120)]


def test_feed_session_spares_the_logs_and_leaves_the_callers(spark):
    from clientlens.streaming import feeder
    key = "spark.sql.streaming.checkpointFileManagerClass"
    kept = [spark.conf.get(k, None) for k in (key, *feeder.FEED_CONF)]
    assert feeder.feed_session(spark, "file:///tmp/x").conf.get(key) == feeder.LOCAL_LOG
    assert feeder.feed_session(spark, "hdfs://host/x").conf.get(key, None) != feeder.LOCAL_LOG
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    st.run_feed(spark.range(30).toDF("a"), "feeder_conf", ["a"], 10)
    assert [spark.conf.get(k, None) for k in (key, *feeder.FEED_CONF)] == kept
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_shared_scan_is_read_once_and_released(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.range(1000).selectExpr("id", "id % 3 AS k", "id % 5 AS j").mapInArrow(counted, "id long, k long, j long")
    with ops.shared_scan(df, ["k", "j"]) as rows:
        assert rows.groupBy("k").count().count() == 3 and rows.groupBy("j").count().count() == 5
        assert rows.storageLevel.useDisk and not rows.storageLevel.useMemory
    assert read.value == 1000 and not rows.storageLevel.useDisk
    with pytest.raises(ValueError):
        with ops.shared_scan(df) as rows:
            rows.count()
            raise ValueError
    assert not rows.storageLevel.useDisk
