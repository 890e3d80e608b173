import math

from pyspark.sql import functions as F

from clientlens import operators as ops


def test_null_counts_one_scan(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert sorted(tuple(r) for r in ops.null_counts(df).collect()) == [("a", 1), ("b", 2)]
    df2 = spark.createDataFrame([(1, "x")], "a int, b string")
    assert ops.null_counts(df2).count() == 0  # only columns with NULLs
    assert ops.null_counts(df2, only_positive=False).count() == 2


def test_describe_numeric_long_form(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    rows = {r["column_name"]: r for r in ops.describe_numeric(df, ["a", "b"]).collect()}
    assert rows["a"]["count"] == 2 and rows["a"]["mean"] == 2.0
    assert math.isclose(rows["a"]["stddev"], math.sqrt(2)) and rows["b"]["max"] == 4.0


def test_spread_population_vs_sample(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", 3.0)], "g string, v double")
    pop = ops.spread_by_group(df, "g", "v", digits=None).collect()[0]
    samp = ops.spread_by_group(df, "g", "v", sample=True, digits=None).collect()[0]
    assert pop["stddev_v"] == 1.0 and math.isclose(samp["stddev_v"], math.sqrt(2))


def test_winsorize_clips_to_fences(spark):
    vals = [float(x) for x in range(1, 21)] + [1000.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "b double")
    fences = ops.iqr_fences(df, "b", rel_error=1e-6).collect()[0]
    out = ops.winsorize_iqr(df, "b", "c", rel_error=1e-6)
    assert out.schema["c"].dataType.simpleString() == "double"
    got = {r["b"]: r["c"] for r in out.collect()}
    assert got[1000.0] == fences["upper"] and got[5.0] == 5.0 and got[None] is None


def test_winsorize_in_plan_equals_tree_fit(spark):
    vals = [float(x) for x in range(1, 41)] + [500.0, -300.0]
    df = spark.createDataFrame([(v,) for v in vals], "b double")
    a = sorted(r[0] for r in ops.winsorize_iqr(df, "b", rel_error=1e-6).collect())
    b = sorted(r[0] for r in ops.winsorize_iqr(df, "b", rel_error=1e-6, in_plan=True).collect())
    assert a == b
    f = ops.iqr_fences(df, "b", rel_error=1e-6, in_plan=True).collect()[0]
    g = ops.iqr_fences(df, "b", rel_error=1e-6).collect()[0]
    assert (f["lower"], f["upper"]) == (g["lower"], g["upper"])


def test_winsorize_fences_from_training_part(spark):
    train = spark.createDataFrame([(float(x),) for x in range(1, 9)], "b double")
    test = spark.createDataFrame([(100.0,)], "b double")
    f = ops.iqr_fences(train, "b", rel_error=1e-6).collect()[0]
    assert ops.winsorize_iqr(test, "b", fit_on=train, rel_error=1e-6).collect()[0][0] == f["upper"]


def test_winsorize_single_subquery(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "b double")
    plan = ops.winsorize_iqr(df, "b", in_plan=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_percentile_approx") == 1  # ONE sketch aggregate


def test_corr_and_count(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, b double")
    # r = 4.5 / sqrt(2 * 10.1667) = 0.99796
    assert ops.corr(df, "a", "b", "r", 3).collect()[0]["r"] == 0.998
    assert ops.total_count(df).collect()[0][0] == 3
    assert ops.preview(df, 2, ["a"]).count() == 2
    assert F is not None


def _brute(values, p):
    xs = sorted(x for x in values if x is not None and x == x)
    return xs[max(1, min(len(xs), math.ceil(p * len(xs)))) - 1] if xs else None


def test_exact_quantiles_iterative_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    values = [rnd.gauss(0, 1) for _ in range(3000)] + [float(round(rnd.random() * 5)) for _ in range(2000)]
    values += [1.0] * 1500 + [None] * 10 + [float("nan")]
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert ops.exact_quantiles(df, "x", probs) == [_brute(values, p) for p in probs]


def test_exact_quantiles_keep_the_type(spark):
    """Neighbours above 2^53, far-apart doubles and decimals stay exact."""
    from decimal import Decimal
    longs = [2 ** 62 + i for i in range(50)] + [-(2 ** 62), 3, 4]
    doubles = [1e308, -1e308, 5e-324, 0.0] + [10.0 ** -k for k in range(1, 200, 7)]
    decimals = [Decimal(10 ** 20 + i) / 100 for i in range(40)]
    probs = [0.1, 0.5, 0.77, 1.0]
    for values, kind in ((longs, "bigint"), (doubles, "double"), (decimals, "decimal(30,2)")):
        df = spark.createDataFrame([(x,) for x in values], f"x {kind}").repartition(3)
        assert ops.exact_quantiles(df, "x", probs) == [_brute(values, p) for p in probs]


def test_exact_quantiles_heavy_ties_and_empty(spark):
    values = [5.0] * 800 + [7.0] * 700 + [6.0]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    probs = [0.3, 0.5333, 0.534, 0.6, 1.0]
    assert ops.exact_quantiles(df, "x", probs) == [_brute(values, p) for p in probs]
    empty = spark.createDataFrame([(None,)], "x double")
    assert ops.exact_quantiles(empty, "x", [0.5]) == [None]


def test_exact_winsorize_fences(spark):
    vals = [float(x) for x in range(1, 101)] + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "b double")
    f = ops.iqr_fences(df, "b", exact=True).collect()[0]
    q1, q3 = _brute(vals, 0.25), _brute(vals, 0.75)
    assert (f["q1"], f["q3"]) == (q1, q3) and f["upper"] == q3 + 1.5 * (q3 - q1)
    out = {r["b"]: r["c"] for r in ops.winsorize_iqr(df, "b", "c", exact=True).collect()}
    assert out[1000.0] == f["upper"] and out[50.0] == 50.0


def test_avg_median_modes_match_brute_force(spark):
    import random
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", None]), float(rnd.randint(1, 9)) if rnd.random() > 0.05 else None)
            for _ in range(3000)] + [("a", 5.0)] * 2000  # a hot group
    df = spark.createDataFrame(rows, "k string, v double")
    want = {k: (_brute([v for kk, v in rows if kk == k], 0.5), sum(kk == k for kk, _ in rows)) for k in ("a", "b", None)}
    for mode in ("histogram", "sketch", "exact"):
        got = ops.avg_median_by_group(df, "k", "v", "v", "a", "m", "n", median=mode).collect()
        assert {r["k"]: (r["m"], r["n"]) for r in got} == want, mode


def test_approx_fences_several_columns_and_all_null(spark):
    rows = [(float(i), None) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "a double, b double")
    f = ops.approx_fences(df, ["a", "b"], rel_error=1e-6)
    q1, q3 = _brute([r[0] for r in rows], 0.25), _brute([r[0] for r in rows], 0.75)
    assert f["a"] == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert f["b"] == (None, None)
    out = ops.winsorize_iqr(df, "b", "c").collect()  # no fences: values stay as they are
    assert all(r["c"] is None for r in out)


def test_quantile_by_group_exact_continuous(spark, monkeypatch):
    import random
    from clientlens.operators import quantiles
    monkeypatch.setattr(quantiles, "BINS", 16)
    rnd = random.Random(5)
    rows = [("hot", rnd.lognormvariate(0, 2)) for _ in range(4000)]
    rows += [(k, rnd.gauss(0, 1)) for k in "abc" for _ in range(300)]
    rows += [("ties", 3.0)] * 500 + [("ties", 1.0)] * 10 + [("one", 7.5), ("n", None), (None, 2.0), (None, 4.0), (None, 9.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    for p in (0.5, 0.9):
        got = {r["k"]: r["q"] for r in
               quantiles.quantile_by_group_exact(df, ["k"], "v", p, "q").collect()}
        keys = {k for k, x in rows if x is not None}
        want = {k: _brute([x for kk, x in rows if kk == k], p) for k in keys}
        assert got == want


def test_avg_median_exact_mode_matches_histogram(spark):
    import random
    rnd = random.Random(9)
    rows = [(rnd.choice("ab"), float(rnd.randint(1, 40)), rnd.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k string, q double, x double")
    h = ops.avg_median_by_group(df, "k", "x", "q", "a", "m", "n", median="histogram", digits=None)
    e = ops.avg_median_by_group(df, "k", "x", "q", "a", "m", "n", median="exact", digits=None)
    hm = {r["k"]: (r["m"], r["n"]) for r in h.collect()}
    em = {r["k"]: (r["m"], r["n"]) for r in e.collect()}
    assert hm == em
