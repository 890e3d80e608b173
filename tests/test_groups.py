from pyspark.sql import functions as F

from clientlens import operators as ops

CLIENTS = [
    # job, marital, education, balance, y, month, loan, age
    ("admin.", "married", "secondary", 100, "yes", "may", "yes", 29),
    ("admin.", "single", "tertiary", 300, "no", "may", "no", 30),
    ("services", "married", "secondary", -50, "no", "jun", "yes", 60),
    ("services", "married", "primary", 2000, "no", "xyz", "yes", 61),
    ("retired", "divorced", "primary", 5000, "maybe", "jun", "no", None),
]
SCHEMA = ("job string, marital string, education string, balance int, y string, "
          "month string, loan string, age int")


def _df(spark):
    return spark.createDataFrame(CLIENTS, SCHEMA)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_filtered_count_absent_vs_rate_zero(spark):
    df = _df(spark)
    counted = _rows(ops.filtered_count_by_group(df, F.col("y") == "yes", "job"))
    assert counted == [("admin.", 1)]  # groups without a hit are absent
    rates = {r[0]: r[3] for r in ops.rate_by_group(df, "job", F.col("y") == "yes").collect()}
    assert rates == {"admin.": 50.0, "retired": 0.0, "services": 0.0}


def test_avg_by_group_skips_null_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None)], "k string, v double")
    assert _rows(ops.avg_by_group(df, "k", "v")) == [("a", 1.0, 1)]


def test_crosstab_other_status_counts_in_neither(spark):
    out = {r["month"]: (r["yes_count"], r["no_count"], r["total"])
           for r in ops.month_status_crosstab(_df(spark), "month", "y").collect()}
    assert out == {"may": (1, 1, 2), "jun": (0, 1, 1), "xyz": (0, 1, 1)}
    order = [r["month"] for r in ops.month_status_crosstab(_df(spark), "month", "y").collect()]
    assert order == ["may", "jun", "xyz"]  # calendar order, unknown (99) last


def test_monthly_trend_aligned(spark):
    rows = ops.monthly_trend(_df(spark), "month").collect()
    assert len(rows) == 12 and [r["month"] for r in rows][:3] == ["jan", "feb", "mar"]
    vol = {r["month"]: r["contact_volume"] for r in rows}
    assert vol["may"] == 2 and vol["jun"] == 2 and vol["jan"] is None and "xyz" not in vol


def test_monthly_trend_unaligned_keeps_unknown_last(spark):
    rows = ops.monthly_trend(_df(spark), "month", align=False).collect()
    assert [r["month"] for r in rows] == ["may", "jun", "xyz"]


def test_pivot_missing_cells_zero(spark):
    out = _rows(ops.pivot_counts(_df(spark), "education", "loan", ["yes", "no"]))
    assert out == [("primary", 1, 1), ("secondary", 2, 0), ("tertiary", 0, 1)]


def test_topk_tie_break_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "k string, v double")
    out = _rows(ops.topk_band_avg(df, F.col("k"), "v", k=2))
    assert [r[0] for r in out] == ["a", "b"]


def test_busiest_and_above_avg(spark):
    df = _df(spark)
    top = _rows(ops.busiest(df, "month", F.col("y") == "yes"))
    assert top == [("jun", 2, 0.0)]  # tie on 2 rows broken by key: jun < may
    above = _rows(ops.above_avg_by_group(df, "balance", "job"))  # mean 1470, strict >
    assert sorted(above) == [("retired", 1), ("services", 1)]


def test_band_stats_text_order(spark):
    df = spark.createDataFrame([(29, 1.0), (100, 5.0), (35, 2.0), (31, 4.0)], "age int, b double")
    from clientlens.functions import decade
    rows = _rows(ops.band_stats(df, decade("age"), "b"))
    assert rows == [("100s", 5.0, 1, 5.0, 5.0), ("20s", 1.0, 1, 1.0, 1.0), ("30s", 3.0, 2, 2.0, 4.0)]


def test_global_metrics_single_scan(spark):
    df = _df(spark)
    out = ops.global_metrics(df, {"avg_balance": ops.mean("balance"),
                                  "subscribed_pct": ops.hit_rate(F.col("y") == "yes"),
                                  "loans": F.count_if(F.col("loan") == "yes")})
    assert _rows(out) == [(1470.0, 20.0, 3)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1  # one scan for all three metrics


def test_partition_stats_keeps_empty_partitions(spark):
    df = spark.createDataFrame([(k,) for k in ["a", "b", "c"] * 10], "job string")
    rows = ops.partition_stats(df, 8, "job").collect()
    assert [r["partition_id"] for r in rows] == list(range(8))
    assert sum(r["row_count"] for r in rows) == 30
    assert sum(1 for r in rows if r["row_count"] == 0) >= 5


def test_sql_and_dataframe_agree(spark):
    df = _df(spark)
    df.createOrReplaceTempView("clients_t")
    sql = spark.sql("""SELECT job, ROUND(AVG(balance), 2) AS avg_balance, COUNT(*) AS count
                       FROM clients_t GROUP BY job""")
    assert sorted(_rows(sql)) == sorted(_rows(ops.avg_by_group(df, "job", "balance", "avg_balance")))


def test_month_quarter_distinct(spark):
    rows = _rows(ops.month_quarter(_df(spark), "month"))
    assert rows == [("jun", "Q2"), ("may", "Q2"), ("xyz", None)]


def test_partition_stats_count_real_partitions(spark):
    df = spark.createDataFrame([(f"k{i % 5}", i) for i in range(500)], "job string, n int").repartition(7)
    parts = df.repartition(8, "job").select("job", F.spark_partition_id().alias("p")).collect()
    want = {}
    for r in parts:
        want[r["p"]] = want.get(r["p"], 0) + 1
    got = {r["partition_id"]: r["row_count"] for r in ops.partition_stats(df, 8, "job").collect()}
    assert got == {i: want.get(i, 0) for i in range(8)}
    keys = ops.partition_keys(df, 8, "job").collect()
    assert len(keys) == 5 and all(r["n_partitions"] == 1 and r["row_count"] == 100 for r in keys)
    even = ops.partition_stats(df, 4).collect()
    assert sum(r["row_count"] for r in even) == 500 and len(even) == 4



def test_pivot_counts_discovers_values(spark):
    out = ops.pivot_counts(_df(spark), "education", "loan")
    assert out.columns == ["education", "no", "yes"]
    assert [tuple(r) for r in out.collect()] == [("primary", 1, 1), ("secondary", 0, 2),
                                                  ("tertiary", 1, 0)]


def test_hot_group_with_one_value_is_dealt_by_row(spark):
    from clientlens.operators import quantiles
    rows = [(None if i % 3 else "b", i, 7.0 if i % 10 else float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, id long, v double")
    got = {r.k: r.m for r in quantiles.quantile_by_group_exact(df, ["k"], "v", 0.95, "m", share_rows=100).collect()}
    for key in (None, "b"):
        values = sorted(v for k, _, v in rows if k == key)
        assert got[key] == values[-(-95 * len(values) // 100) - 1]
    state = spark.createDataFrame([(None, 20), ("b", 1)], "k string, __shares int")
    data = df.select("k", df.v.alias("__v"), F.xxhash64("k", "id", "v").alias("__row"))
    shares = quantiles._dealt(data, state, ["k"]).where("__v = 7").groupBy("k", "__salt").count().collect()
    assert len([r for r in shares if r.k is None]) == 20 and [r["__salt"] for r in shares if r.k == "b"] == [0]
    assert max(r["count"] for r in shares if r.k is None) < 200


def test_rows_by_named_partition(spark):
    from clientlens import operators as ops
    df = spark.createDataFrame([(1,), (1,), (13,), (None,)], "p int")
    assert [tuple(r) for r in ops.partition_rows(df, 5, F.col("p")).collect()] == [(0, 1), (1, 2), (2, 0), (3, 1), (4, 0)]
