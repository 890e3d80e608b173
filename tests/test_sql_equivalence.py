"""The batch analyses against plain Python over a generated 17-column client
table (deterministic rule, 2,000 rows)."""
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest

from clientlens.reports.batch import dataframe_analyses, sql_analyses
from clientlens.schema import MONTHS, client_schema

JOBS = ["admin.", "blue-collar", "entrepreneur", "housemaid", "management", "retired",
        "self-employed", "services", "student", "technician", "unemployed", "unknown"]


def _client(i):
    return (18 + (i * 7) % 70, JOBS[i % 12], ["married", "single", "divorced"][i % 3],
            ["primary", "secondary", "tertiary", "unknown"][(i // 3) % 4],
            "yes" if i % 23 == 0 else "no", (i * 131) % 20000 - 1500,
            "yes" if i % 2 else "no", "yes" if i % 5 == 0 else "no",
            ["cellular", "telephone", "unknown"][(i // 7) % 3], 1 + i % 28,
            MONTHS[(i * i) % 12], (i * 17) % 1000, 1 + i % 6,
            -1 if i % 4 else i % 300, i % 3,
            ["success", "failure", "other", "unknown"][(i // 5) % 4],
            "yes" if i % 9 == 0 or (i % 7 == 0 and i % 2 == 0) else "no")


ROWS = [dict(zip([f.name for f in client_schema().fields], _client(i))) for i in range(2000)]


def _round(x: Fraction, digits: int = 2) -> float:
    step = Decimal(1).scaleb(-digits)
    return float((Decimal(x.numerator) / Decimal(x.denominator)).quantize(step, ROUND_HALF_UP))


def _mean(values):
    return Fraction(sum(values), len(values))


def _groups(key, rows=ROWS):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def _share(rows, col):
    return _round(Fraction(100 * sum(r[col] == "yes" for r in rows), len(rows)))


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([_client(i) for i in range(2000)], client_schema())
    return {**dataframe_analyses(df), **sql_analyses(df)}


def _rows(results, name):
    return [tuple(r) for r in results[name].collect()]


def test_counts(results):
    assert _rows(results, "total_clients") == [(2000,)]
    assert _rows(results, "high_balance_clients") == [(sum(r["balance"] > 1000 for r in ROWS),)]
    by_job = Counter(r["job"] for r in ROWS)
    assert dict(_rows(results, "clients_by_job")) == by_job
    assert dict(_rows(results, "defaults_by_education")) == Counter(r["education"] for r in ROWS if r["default"] == "yes")
    assert dict(_rows(results, "subscribed_by_marital")) == Counter(r["marital"] for r in ROWS if r["y"] == "yes")


def test_means(results):
    got = dict(_rows(results, "call_duration_by_subscription"))
    want = {k: float(_mean([r["duration"] for r in g])) for k, g in _groups("y").items()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) <= 0.005 + 1e-9 for k in want)
    ages = {r[0]: r[1] for r in _rows(results, "avg_age_by_job")}
    want = {k: float(_mean([r["age"] for r in g])) for k, g in _groups("job").items()}
    assert set(ages) == set(want) and all(abs(ages[k] - want[k]) <= 0.005 + 1e-9 for k in want)


def test_rates(results):
    got = {r[0]: r[1:] for r in _rows(results, "subscription_by_previous_outcome")}
    assert got == {k: (len(g), sum(r["y"] == "yes" for r in g), _share(g, "y")) for k, g in _groups("poutcome").items()}
    top = [(k, len(g), sum(r["default"] == "yes" for r in g), _share(g, "default")) for k, g in _groups("job").items()]
    assert _rows(results, "top3_jobs_by_default_rate") == sorted(top, key=lambda x: (-x[3], x[0]))[:3]


def test_rankings(results):
    best = sorted(((r["job"], r["marital"], r["balance"]) for r in ROWS), key=lambda x: (-x[2], x[0], x[1]))[:10]
    assert _rows(results, "top10_balances") == best
    month, rows = min(_groups("month").items(), key=lambda x: (-len(x[1]), x[0]))
    assert _rows(results, "busiest_month") == [(month, len(rows), _share(rows, "y"))]
    jobs = [(k, float(_mean([r["balance"] for r in g])), _share(g, "y")) for k, g in _groups("job").items()]
    want = sorted(jobs, key=lambda x: (-x[1], x[0]))[:5]
    got = _rows(results, "top5_jobs_by_balance_with_rate")
    assert [(a, c) for a, _, c in got] == [(a, c) for a, _, c in want]
    assert all(abs(x[1] - w[1]) <= 0.005 + 1e-9 for x, w in zip(got, want))


def test_filters_and_order(results):
    married = [tuple(r.values()) for r in ROWS if r["marital"] == "married" and r["loan"] == "yes"]
    assert sorted(_rows(results, "married_with_loan")) == sorted(married)
    volume = Counter(r["month"] for r in ROWS)
    assert [r[:2] for r in _rows(results, "monthly_contact_volume")] == [(m, volume[m]) for m in MONTHS if m in volume]
    mean = _mean([r["balance"] for r in ROWS])
    assert dict(_rows(results, "high_balance_subscribers_by_education")) == Counter(
        r["education"] for r in ROWS if r["y"] == "yes" and r["balance"] > mean)


def test_spread_is_the_population_one(results):
    for r in results["balance_spread_by_education"].collect():
        values = [x["balance"] for x in ROWS if x["education"] == r["education"]]
        m = _mean(values)
        deviation = float(sum((v - m) ** 2 for v in values) / len(values)) ** 0.5
        assert abs(r["stddev_balance"] - deviation) <= 0.005 + 1e-9
        assert (r["min_balance"], r["max_balance"]) == (min(values), max(values))


def test_sentinel_and_bands(spark, results):
    from pyspark.sql import functions as F

    from clientlens import functions as fn
    df = spark.createDataFrame([_client(i) for i in range(2000)], client_schema())
    got = df.select(fn.replace_sentinel("pdays").alias("p")).groupBy("p").count().collect()
    assert {r["p"]: r["count"] for r in got} == Counter(0 if r["pdays"] == -1 else r["pdays"] for r in ROWS)
    bands = df.groupBy(fn.band5("age").alias("b")).agg(F.count("*").alias("n")).collect()
    assert {r["b"]: r["n"] for r in bands} == Counter(f"{r['age'] // 5 * 5}-{r['age'] // 5 * 5 + 4}" for r in ROWS)
