"""Stored quantile sketches."""
import random

from clientlens import operators as ops


def ranks_ok(values, q, p, slack=0.02):
    below, upto = sum(v < q for v in values), sum(v <= q for v in values)
    return below <= (p + slack) * len(values) and upto >= (p - slack) * len(values)


def test_merged_sketches_of_two_days(spark):
    r = random.Random(2)
    rows = [(d, r.choice(["a", "b", None]), r.choice([None, r.gauss(0, 1), float(r.randint(0, 3))])) for d in range(2) for _ in range(6000)]
    rows += [(1, "hot", float(i)) for i in range(8000)]
    df = spark.createDataFrame(rows, "day int, g string, v double").repartition(40)
    days = [ops.quantile_sketches(df.where(f"day = {d}"), ["g"], "v", salts=4) for d in range(2)]
    stored = days[0].unionByName(days[1])
    assert stored.where("g = 'hot'").count() <= 4
    found = ops.sketch_quantiles(ops.merge_sketches(stored, ["g"]), [0, 0.25, 0.5, 1], ["low", "q1", "mid", "high"]).collect()
    assert {x.g for x in found} == {"a", "b", None, "hot"}
    for x in found:
        values = [v for _, g, v in rows if g == x.g and v is not None]
        assert (x.row_count, x.low, x.high) == (len(values), min(values), max(values))
        assert ranks_ok(values, x.q1, 0.25) and ranks_ok(values, x.mid, 0.5)


def test_edges(spark):
    df = spark.createDataFrame([("x", None), ("y", 1.0)], "g string, v double")
    merged = ops.merge_sketches(ops.quantile_sketches(df, ["g"], "v"), ["g"])
    assert [tuple(r) for r in ops.sketch_quantiles(merged, [0.5], ["mid"]).collect()] == [("y", 1, 1.0)]
    none = ops.quantile_sketches(df.where("false"), ["g"], "v")
    assert ops.merge_sketches(none, ["g"]).count() == 0


def test_kll_median_mode(spark):
    rows = [(k, float(i)) for k, n in (("a", 4000), ("b", 11)) for i in range(n)] + [(None, 5.0), ("n", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(20)
    got = {r.k: r for r in ops.avg_median_by_group(df, "k", "v", "v", "m", "med", "n", median="kll").collect()}
    assert {k: r.n for k, r in got.items()} == {"a": 4000, "b": 11, None: 1, "n": 1}
    assert ranks_ok([float(i) for i in range(4000)], got["a"].med, 0.5) and got["b"].med == 5.0 and got["n"].med is None
