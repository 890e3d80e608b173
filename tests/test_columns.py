from pyspark.sql import functions as F

from clientlens import functions as fn


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_group_edges(spark):
    out = _one(spark, [(29,), (30,), (60,), (61,), (None,)], "age int", fn.age_group("age"))
    assert out == ["<30", "30-60", "30-60", ">60", "unknown"]


def test_band5_edges(spark):
    out = _one(spark, [(30,), (34,), (35,), (None,), (-1,)], "age int", fn.band5("age"))
    # floor division like Python's //: -1 // 5 == -1 -> band -5..-1
    assert out == ["30-34", "30-34", "35-39", "unknown", "-5--1"]


def test_decade_labels_sort_as_text(spark):
    df = spark.createDataFrame([(29,), (30,), (100,)], "age int")
    out = [r[0] for r in df.select(fn.decade("age").alias("d")).orderBy("d").collect()]
    assert out == ["100s", "20s", "30s"]


def test_month_maps(spark):
    df = spark.createDataFrame([("jan",), ("dec",), ("xyz",)], "month string")
    rows = df.select(fn.quarter_of("month"), fn.month_ordinal("month"),
                     fn.month_ordinal("month", unknown=None)).collect()
    assert [tuple(r) for r in rows] == [("Q1", 1, 1), ("Q4", 12, 12), (None, 99, None)]


def test_sentinel_keeps_type(spark):
    df = spark.createDataFrame([(-1,), (5,), (None,)], "pdays int")
    out = df.select(fn.replace_sentinel("pdays").alias("p"))
    assert out.schema["p"].dataType.simpleString() == "int"
    assert [r[0] for r in out.collect()] == [0, 5, None]


def test_parse_numbers(spark):
    df = spark.createDataFrame([(" 12 ",), ("12.5",), ("abc",), (None,)], "x string")
    rows = df.select(fn.parse_int("x"), fn.parse_double("x")).collect()
    assert [tuple(r) for r in rows] == [(12, 12.0), (None, 12.5), (None, None), (None, None)]


def test_percent_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(fn.percent("a", "b")).collect()] == [33.33, None]


def test_string_features(spark):
    df = spark.createDataFrame([("admin.", None, "cellular"), ("services", "single", None)],
                               "job string, marital string, contact string")
    rows = df.select(fn.joined("_", "job", "marital"), fn.upper("contact")).collect()
    assert [tuple(r) for r in rows] == [("admin.", "CELLULAR"), ("services_single", None)]


def test_event_time_default(spark):
    df = spark.createDataFrame([(None,)], "event_time timestamp")
    assert df.select(fn.with_event_time("event_time")).collect()[0][0] is not None


def test_native_expressions_no_python_udf(spark):
    df = spark.createDataFrame([(31,)], "age int").select(fn.age_group("age"), fn.band5("age"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None


def test_sql_functions_equal_column_functions(spark):
    from clientlens.functions import register_sql_functions
    register_sql_functions(spark)
    df = spark.createDataFrame([(a, m) for a, m in
                                [(29.0, "jan"), (30.0, "may"), (60.0, "xyz"), (61.0, "dec"),
                                 (None, None), (104.0, "oct")]], "age double, month string")
    df.createOrReplaceTempView("fn_t")
    sql = spark.sql("SELECT age_group(age), age_band5(age), decade_band(age), "
                    "month_quarter(month), month_ordinal(month) FROM fn_t").collect()
    cols = df.select(fn.age_group("age"), fn.band5("age"), fn.decade("age"),
                     fn.quarter_of("month"), fn.month_ordinal("month")).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in cols]


def test_cluster_conf_sizes_partitions():
    from clientlens.session import cluster_conf
    conf = cluster_conf(100 * 10 ** 12, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == -(-100 * 10 ** 12 // (256 << 20))
    assert cluster_conf(10 << 20, 64)["spark.sql.shuffle.partitions"] == "128"
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_fixed_point_mean_ties_and_layout_independence(spark):
    # mean 27.72125 is a decimal tie at 4 digits: half away from zero
    vals = [27.70, 27.71, 27.72, 27.73, 27.74, 27.75, 27.72, 27.70]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = {df.repartition(n).agg(fn.fixed_point_mean("v", 2, 4)).collect()[0][0] for n in (1, 3, 8)}
    assert got == {27.7213}
    neg = spark.createDataFrame([(-0.01,), (-0.02,)], "v double")
    assert neg.agg(fn.fixed_point_mean("v", 2, 2)).collect()[0][0] == -0.02  # -0.015 -> -0.02
    ints = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    assert ints.agg(fn.fixed_point_mean("v", 0, 0)).collect()[0][0] == 2.0  # 1.5 -> 2


def test_percent_decimal_tie_rounds_half_up(spark):
    # 201 / 20000 = 1.005 %: a decimal tie that a double cannot hold exactly
    df = spark.createDataFrame([(201, 20000), (1, 8), (2, 3)], "h long, t long")
    assert [r[0] for r in df.select(fn.percent("h", "t")).collect()] == [1.01, 12.5, 66.67]
