"""Batch analyses on the driver fixture tables.

The client table of the original analyses does not exist here, so each
analysis runs with its roles mapped onto fixture columns:

* job -> ``c_mktsegment`` / ``o_orderpriority`` / ``l_returnflag``
* balance -> ``c_acctbal`` / ``o_totalprice`` / ``l_extendedprice``
* age -> ``l_quantity`` (1..50) or ``events.user_id`` (0..149)
* y = 'yes' -> ``o_orderstatus = 'F'``; month -> month of ``o_orderdate``

Every function takes ``(spark, sf_dir)``, reads whole tables and returns a
lazy DataFrame whose column names match the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import functions as fn
from clientlens import operators as ops
from clientlens.session import scratch_path
from clientlens.sources import read_table


# Money columns of the fixtures carry exactly 2 decimals: their means are
# summed exactly in cents (see ``fixed_point_mean``), so results do not
# depend on summation order and ties round the same in every engine.
MONEY = 2


def finished():
    """The fixture's "subscribed" flag: order status F."""
    return F.col("o_orderstatus") == "F"


def _orders_with_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").withColumn("month", fn.month_name("o_orderdate"))


def _odd_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with month names nobody knows: 'zzz' for every 89th order key and
    for all of February (which is absent then), NULL for every 97th."""
    key, month = F.col("o_orderkey"), F.col("month")
    odd = F.when((key % 89 == 0) | (month == "feb"), "zzz").when(key % 97 == 0, None).otherwise(month)
    return _orders_with_month(spark, sf_dir).withColumn("month", odd)


def total_count(spark, sf_dir):
    return ops.total_count(read_table(spark, sf_dir, "lineitem"), "total_rows")


def preview(spark, sf_dir):
    """First 10 line items in a total order (order key and line number repeat
    in the fixture, so every column takes part in the order)."""
    li = read_table(spark, sf_dir, "lineitem")
    # the tenth smallest order key, from one column; the range filter on it then
    # skips all other row groups, and whole rows are ordered for a few keys only
    keys = ops.preview(li.select("l_orderkey"), 10, ["l_orderkey"]).agg(F.max("l_orderkey")).first()[0]
    first = ["l_orderkey", "l_linenumber"]
    return ops.preview(li.where(F.col("l_orderkey") <= F.lit(keys)), 10, first + [c for c in li.columns if c not in first])


def count_by(spark, sf_dir):
    return ops.count_by(read_table(spark, sf_dir, "lineitem"),
                        ["l_returnflag", "l_linestatus"], "row_count")


def filter_conj(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.where((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"))


def filter_threshold(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer")
    return ops.total_count(cu.where(F.col("c_acctbal") > 1000), "high_balance_count")


def topk_rows(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer")
    return ops.top_k(cu.select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"),
                     10, F.desc("c_acctbal"), F.asc("c_custkey"))


def topk_frequent(spark, sf_dir):
    counts = ops.count_by(read_table(spark, sf_dir, "lineitem"), "l_partkey", "row_count")
    return ops.top_k(counts, 5, F.desc("row_count"), F.asc("l_partkey"))


def avg_by_group(spark, sf_dir):
    return ops.avg_by_group(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                            "l_extendedprice", "avg_extendedprice", "row_count", scale=MONEY)


def avg_by_group_two_keys(spark, sf_dir):
    return ops.avg_by_group(read_table(spark, sf_dir, "lineitem"),
                            ["l_returnflag", "l_linestatus"], "l_quantity",
                            "avg_quantity", "row_count", scale=0)


def avg_median_by_group(spark, sf_dir):
    return ops.avg_median_by_group(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                                   "l_extendedprice", "l_quantity", "avg_extendedprice",
                                   "median_quantity", "row_count", scale=MONEY,
                                   median="histogram")  # 50 distinct quantities: exact


def filtered_count_by_group(spark, sf_dir):
    return ops.filtered_count_by_group(read_table(spark, sf_dir, "orders"), finished(),
                                       "o_orderpriority", "finished_count")


def rate_by_group(spark, sf_dir):
    return ops.rate_by_group(read_table(spark, sf_dir, "orders"), "o_orderpriority", finished(),
                             "total_orders", "finished_orders", "finished_rate_pct")


def topk_rate(spark, sf_dir):
    return ops.topk_rate(read_table(spark, sf_dir, "customer"), "c_nationkey",
                         F.col("c_acctbal") > 5000, k=3, total_name="total_customers",
                         hits_name="rich_customers", rate_name="rich_rate_pct")


def topk_avg_with_rate(spark, sf_dir):
    return ops.topk_avg_with_rate(read_table(spark, sf_dir, "orders"), "o_custkey",
                                  "o_totalprice", finished(), k=5, avg_name="avg_totalprice",
                                  rate_name="finished_rate_pct", scale=MONEY)


def busiest_month(spark, sf_dir):
    return ops.busiest(_orders_with_month(spark, sf_dir), "month", finished())


def monthly_trend(spark, sf_dir):
    """February is absent: its row has a NULL count (shown as a flag beside 0,
    since a whole number with gaps has no common form in data frames)."""
    trend = ops.monthly_trend(_odd_months(spark, sf_dir), "month", "contact_volume")
    return trend.withColumn("is_absent", F.col("contact_volume").isNull()).fillna(0, subset=["contact_volume"])


def month_quarter(spark, sf_dir):
    return ops.month_quarter(_odd_months(spark, sf_dir), "month")


def avg_by_quarter(spark, sf_dir):
    return ops.avg_by_quarter(_orders_with_month(spark, sf_dir), "month", "o_totalprice",
                              "avg_totalprice", scale=MONEY)


def month_status_crosstab(spark, sf_dir):
    return ops.month_status_crosstab(_orders_with_month(spark, sf_dir), "month",
                                     "o_orderstatus", yes="F", no="O")


def pivot_counts(spark, sf_dir):
    """Returned items are all finished here, so their open cell is empty."""
    li = read_table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "F").otherwise(F.col("l_linestatus"))
    return ops.pivot_counts(li.withColumn("l_linestatus", status), "l_returnflag", "l_linestatus", ["F", "O"])


def age_band5(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return ops.count_by(li.withColumn("band", fn.band5("l_quantity")), "band", "row_count")


def topk_band_avg(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return ops.topk_band_avg(li, fn.band5("l_quantity"), "l_extendedprice",
                             F.col("l_returnflag") == "R", k=5, avg_name="avg_extendedprice",
                             count_name="row_count", scale=MONEY)


def age_group(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")  # every 97th age is missing
    age = F.when(F.col("event_id") % 97 != 0, F.col("user_id"))
    return ops.count_by(ev.withColumn("age_group", fn.age_group(age)),
                        "age_group", "row_count")


def band_stats(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ops.band_stats(ev, fn.decade("user_id"), "value", "band", "avg_value",
                          "row_count", "min_value", "max_value", scale=MONEY)


def corr(spark, sf_dir):
    return ops.corr(read_table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice",
                    "corr_quantity_price", digits=6)


def spread_by_group(spark, sf_dir):
    return ops.spread_by_group(read_table(spark, sf_dir, "lineitem"), "l_returnflag",
                               "l_extendedprice",
                               names={"avg": "avg_price", "stddev": "stddev_price",
                                      "min": "min_price", "max": "max_price"}, scale=MONEY)


def describe_numeric(spark, sf_dir):
    return ops.describe_numeric(read_table(spark, sf_dir, "lineitem"),
                                ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                                digits=4, scale={"l_quantity": 0, "l_extendedprice": MONEY,
                                                 "l_discount": MONEY, "l_tax": MONEY})


def null_counts(spark, sf_dir):
    """Events with gaps: no value for every 97th, no user for every 89th."""
    ev, key = read_table(spark, sf_dir, "events"), F.col("event_id")
    return ops.null_counts(ev.withColumns({"value": F.when(key % 97 != 0, F.col("value")),
                                           "user_id": F.when(key % 89 != 0, F.col("user_id"))}), only_positive=False)


def global_metrics(spark, sf_dir):
    return ops.global_metrics(read_table(spark, sf_dir, "orders"), {
        "avg_totalprice": ops.mean("o_totalprice", 2, MONEY),
        "finished_pct": ops.hit_rate(finished()),
        "urgent_count": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
    })


def winsorize_iqr(spark, sf_dir):
    """Clip event values to IQR fences from exact quartiles (a few binning
    passes, scale-safe)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    return ops.winsorize_iqr(ev, "value", "value_clipped", exact=True)


def _rank_errors(df: DataFrame, keys: list[str], value: str, found: DataFrame, p: float, quantile: str) -> DataFrame:
    """Per group: rows and whether the sketch's answer is within 0.01 of the
    wanted rank (ranks of its ties included), counted in one pass."""
    v, q = F.col(value), F.col(quantile)
    own = found.select(*[F.col(k).alias(f"__{k}") for k in keys], quantile)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = df.join(own, same).groupBy(*keys).agg(F.count(v).alias("n"), F.count_if(v < q).alias("below"), F.count_if(v <= q).alias("upto"))
    near = (F.col("below") <= (p + 0.01) * F.col("n")) & (F.col("upto") >= (p - 0.01) * F.col("n"))
    return out.select(*keys, F.col("n").alias("row_count"), near.alias("rank_error_ok"))


def avg_median_sketch(spark, sf_dir):
    """The default (sketch) median of a continuous column per group, checked
    by its rank."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", "l_quantity")
    found = ops.avg_median_by_group(li, "l_returnflag", "l_quantity", "l_extendedprice", "avg_quantity", "median_price", scale=0)
    return _rank_errors(li, ["l_returnflag"], "l_extendedprice", found.select("l_returnflag", "median_price"), 0.5, "median_price")


def kll_quantiles(spark, sf_dir):
    """Stored sketches: one table of KLL sketches per flag, status and salt,
    written, read and merged to flags; number, least and greatest value, and
    the rank of the median."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    path = scratch_path(spark, "kll_sketches")
    ops.quantile_sketches(li, ["l_returnflag", "l_linestatus"], "l_extendedprice").write.parquet(path)
    found = ops.sketch_quantiles(ops.merge_sketches(spark.read.parquet(path), ["l_returnflag"]), [0, 0.5, 1],
                                 ["min_price", "median_price", "max_price"], "sketched")
    ranks = _rank_errors(li, ["l_returnflag"], "l_extendedprice", found, 0.5, "median_price")
    return ranks.join(found.drop("median_price"), "l_returnflag")


def winsorize_sketch(spark, sf_dir):
    """IQR fences and clipping from ``approxQuantile`` with rank error 0.01
    (the default): the quartiles' ranks, and that nothing lies outside."""
    ev = read_table(spark, sf_dir, "events").select("value")
    q1, q3, low, high = ops.iqr_fences(ev, "value", rel_error=0.01).first()
    clipped = ops.winsorize_iqr(ev, "value", "clipped", rel_error=0.01)
    v, n = F.col("value"), F.col("row_count")
    out = clipped.agg(
        F.count(v).alias("row_count"), *[F.count_if(v < q).alias(f"b{i}") for i, q in enumerate((q1, q3))],
        *[F.count_if(v <= q).alias(f"u{i}") for i, q in enumerate((q1, q3))],
        F.count_if((F.col("clipped") < low) | (F.col("clipped") > high)).alias("outside"))
    ok = F.lit(True)
    for i, p in enumerate((0.25, 0.75)):  # 0.02: the sketch's error on either side of a tie
        ok = ok & (F.col(f"b{i}") <= (p + 0.02) * n) & (F.col(f"u{i}") >= (p - 0.02) * n)
    return out.select("row_count", ok.alias("rank_error_ok"), "outside")


QUANTILE_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


def exact_quantiles(spark, sf_dir):
    """Exact quantiles of every line item's extended price, one row per
    probability."""
    li = read_table(spark, sf_dir, "lineitem")
    values = ops.exact_quantiles(li, "l_extendedprice", QUANTILE_PROBS)
    return spark.createDataFrame([(float(p), v) for p, v in zip(QUANTILE_PROBS, values)],
                                 "p double, value double")


def exact_median_by_group(spark, sf_dir):
    """Exact median of a continuous column (extended price) per return flag;
    every 97th order's lines have no flag and form a group of their own."""
    li = read_table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_orderkey") % 97 != 0, F.col("l_returnflag"))
    return ops.quantile_by_group_exact(li.select(flag.alias("l_returnflag"), "l_extendedprice"), ["l_returnflag"],
                                       "l_extendedprice", 0.5, "median_extendedprice")


def replace_sentinel(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders")
    gap = F.pmod(F.col("o_custkey"), F.lit(10)).cast("int")
    with_sentinel = od.select("o_orderkey",
                              F.when(gap == 0, F.lit(-1)).otherwise(gap).alias("contact_gap"))
    return with_sentinel.withColumn("contact_gap", fn.replace_sentinel("contact_gap", -1, 0))


def string_features(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer")
    return cu.select("c_custkey",
                     fn.joined("_", "c_mktsegment", "c_name").alias("segment_name"),
                     fn.upper("c_name").alias("name_upper"))


def above_avg_by_group(spark, sf_dir):
    return ops.above_avg_by_group(read_table(spark, sf_dir, "customer"), "c_acctbal",
                                  "c_mktsegment", F.col("c_nationkey") < 10, "client_count")


def sql_view_agg(spark, sf_dir):
    """SQL text over a temp view, banding with the registered SQL function."""
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView("clientlens_lineitem")
    fn.register_sql_functions(spark)
    return spark.sql("""
        SELECT age_group(l_quantity) AS age_group,
               COUNT(*) AS row_count,
               ROUND(AVG(l_extendedprice), 2) AS avg_extendedprice
        FROM clientlens_lineitem
        GROUP BY 1
        ORDER BY 1
    """)


def partition_stats(spark, sf_dir):
    """Facts of a real hash repartition into 8 that hold for any hash: its
    partitions, its rows, and keys that lie in more than one partition."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag")
    stats = ops.partition_stats(li, 8, "l_returnflag")
    spread = ops.partition_keys(li, 8, "l_returnflag")
    return stats.agg(F.count(F.lit(1)).alias("partitions"), F.sum("row_count").alias("row_count")).withColumn(
        "split_keys", spread.agg(F.count_if(F.col("n_partitions") > 1)).scalar())


def partition_rows(spark, sf_dir):
    """Rows of each of 10 partitions that the line number names (1 to 7: three
    partitions are empty)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_linenumber")
    return ops.partition_rows(li, 10, F.col("l_linenumber"))


def with_event_time(spark, sf_dir):
    """Events whose timestamp is missing for every 50th: given ones pass
    through, missing ones get the processing time."""
    ev, key = read_table(spark, sf_dir, "events"), F.col("event_id")
    gaps = ev.select("event_id", F.when(key % 50 != 0, F.col("ts")).alias("ts"))
    timed = gaps.select("event_id", "ts", fn.with_event_time("ts", ntz=True).alias("event_time"))
    return timed.select("event_id", F.col("event_time").eqNullSafe(F.col("ts")).alias("kept"),
                        (F.col("ts").isNull() & (F.abs(F.timestamp_diff("SECOND", F.localtimestamp(), F.col("event_time"))) <= 3600)
                         ).alias("is_processing_time"))


QUERIES = {
    "total_count": total_count,
    "preview": preview,
    "count_by": count_by,
    "filter_conj": filter_conj,
    "filter_threshold": filter_threshold,
    "topk_rows": topk_rows,
    "topk_frequent": topk_frequent,
    "avg_by_group": avg_by_group,
    "avg_by_group_two_keys": avg_by_group_two_keys,
    "avg_median_by_group": avg_median_by_group,
    "filtered_count_by_group": filtered_count_by_group,
    "rate_by_group": rate_by_group,
    "topk_rate": topk_rate,
    "topk_avg_with_rate": topk_avg_with_rate,
    "busiest_month": busiest_month,
    "monthly_trend": monthly_trend,
    "month_quarter": month_quarter,
    "avg_by_quarter": avg_by_quarter,
    "month_status_crosstab": month_status_crosstab,
    "pivot_counts": pivot_counts,
    "age_band5": age_band5,
    "topk_band_avg": topk_band_avg,
    "age_group": age_group,
    "band_stats": band_stats,
    "corr": corr,
    "spread_by_group": spread_by_group,
    "describe_numeric": describe_numeric,
    "null_counts": null_counts,
    "global_metrics": global_metrics,
    "winsorize_iqr": winsorize_iqr,
    "winsorize_sketch": winsorize_sketch,
    "avg_median_sketch": avg_median_sketch,
    "kll_quantiles": kll_quantiles,
    "exact_quantiles": exact_quantiles,
    "exact_median_by_group": exact_median_by_group,
    "replace_sentinel": replace_sentinel,
    "string_features": string_features,
    "above_avg_by_group": above_avg_by_group,
    "sql_view_agg": sql_view_agg,
    "partition_stats": partition_stats,
    "partition_rows": partition_rows,
    "with_event_time": with_event_time,
}
