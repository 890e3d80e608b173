"""The runnable reports on a generated client CSV."""
import os

import pytest
from pyspark.sql import functions as F

from clientlens import operators as ops
from clientlens.reports import batch, models, partitions, streams
from clientlens.reports.common import write_report
from clientlens.schema import client_schema
from test_sql_equivalence import _client


@pytest.fixture(scope="module")
def client_csv(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("bank") / "bank")
    df = spark.createDataFrame([_client(i) for i in range(2000)], client_schema())
    df.coalesce(2).write.option("header", True).csv(folder)
    return folder


def test_batch_report(spark, client_csv, tmp_dir):
    results = batch.batch_report(spark, client_csv)
    assert len(results) >= 30
    out = os.path.join(tmp_dir, "batch")
    written = write_report(results, out)
    assert len(written) == len(results)
    total = spark.read.parquet(os.path.join(out, "total_clients")).collect()[0][0]
    assert total == 2000
    mr1 = {r["job"]: r["avg_balance"] for r in
           spark.read.parquet(os.path.join(out, "mr1_avg_balance_by_job")).collect()}
    df = spark.read.schema(client_schema()).option("header", True).csv(client_csv)
    direct = {r["job"]: r["avg_balance"] for r in
              ops.avg_by_group(df, "job", "balance", "avg_balance").collect()}
    assert mr1 == direct  # text path (clean + parse) agrees with the typed path
    months = df.select("month").distinct().count()
    assert spark.read.parquet(os.path.join(out, "mr3_contacts_by_month_and_status")).count() == months


def test_model_and_stream_reports(spark, client_csv, tmp_dir):
    results, model = models.model_report(spark, client_csv, num_trees=5, max_depth=3,
                                         partitions=4)
    out = os.path.join(tmp_dir, "models")
    write_report(results, out)
    m = spark.read.parquet(os.path.join(out, "test_metrics")).collect()[0]
    assert 0 <= m["auc_roc"] <= 1 and m["train_rows"] + m["test_rows"] == 2000
    model_dir = os.path.join(tmp_dir, "model")
    model.write().save(model_dir)
    incoming = os.path.join(tmp_dir, "incoming")
    spark.read.schema(client_schema()).option("header", True).csv(client_csv) \
        .limit(120).coalesce(1).write.option("header", True).csv(incoming)
    stream_out = os.path.join(tmp_dir, "stream-out")
    streams.main(["--input-dir", incoming, "--out", stream_out, "--model", model_dir,
                  "--available-now"])
    assert spark.read.parquet(os.path.join(stream_out, "ml_predictions")).count() == 120
    assert spark.read.parquet(os.path.join(stream_out, "job_aggregation")) \
        .agg(F.max("transaction_count")).collect()[0][0] > 0


def test_partition_report_cli(spark, client_csv, tmp_dir):
    out = os.path.join(tmp_dir, "parts")
    partitions.main(["--input", client_csv, "--out", out, "--format", "csv"])
    rows = spark.read.option("header", True).csv(os.path.join(out, "rows_per_partition"))
    assert rows.count() == 8
    assert sum(int(r["row_count"]) for r in rows.collect()) == 2000


def test_batch_report_staged_equals_direct(spark, client_csv, tmp_dir):
    staged = batch.batch_report(spark, client_csv, staged=True, stage_dir=os.path.join(tmp_dir, "st"))
    direct = batch.batch_report(spark, client_csv, staged=False)
    for name in ["subscription_rate_by_education", "mr5_balance_by_age_decade", "busiest_month"]:
        assert sorted(map(tuple, staged[name].collect())) == sorted(map(tuple, direct[name].collect()))
    plan = staged["subscription_rate_by_education"]._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "education" in plan


def test_sql_report_runs_a_file(spark, client_csv, tmp_dir):
    from clientlens.reports import sql as sql_report
    from clientlens.sources import load_clients
    path = os.path.join(tmp_dir, "own.sql")
    with open(path, "w") as f:
        f.write("-- name: by_band\nSELECT age_band5(age) AS band, COUNT(*) AS n FROM client_info GROUP BY 1;\n"
                "-- name: young\nSELECT COUNT(*) AS n FROM client_info WHERE age < 30;\n")
    df = load_clients(spark, client_csv)
    res = sql_report.sql_report(spark, df, path)
    ages = [_client(i)[0] for i in range(2000)]
    assert {r["band"]: r["n"] for r in res["by_band"].collect()} == {
        f"{a}-{a + 4}": sum(a <= x < a + 5 for x in ages) for a in {x // 5 * 5 for x in ages}}
    assert res["young"].first()["n"] == sum(x < 30 for x in ages)
    with pytest.raises(SystemExit):
        sql_report.main(["--input", client_csv, "--out", tmp_dir])


def test_named_statements_layout():
    from clientlens.reports.sql import named_statements
    text = """-- header comment
-- name: first
SELECT 1 AS x;   -- trailing
-- a comment inside
-- name: empty
-- name: second
SELECT 2
  AS y;
"""
    got = named_statements(text)
    assert list(got) == ["first", "second"]
    assert got["first"] == "SELECT 1 AS x" and got["second"] == "SELECT 2\n  AS y"
