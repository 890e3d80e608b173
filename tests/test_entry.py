"""The driver contract: entry smoke, registered queries, oracle parity."""
import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from clientlens.plans import registry

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))
from oracle_check import type_diff  # noqa: E402

SLOW = {"tune_rf"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "finished_rate_pct" in df.columns


def test_oracle_keys_are_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["customer", "orders", "lineitem", "events", "supplier"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - SLOW))
def test_query_against_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    pdf = df.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(pdf.columns) > 0
        return
    opdf = duck.execute(sql).df()
    assert sorted(pdf.columns) == sorted(opdf.columns)
    assert type_diff(df, duck, sql) == {}
    assert len(pdf) == len(opdf)
    assert _rows(pdf) == _rows(opdf)


def test_partition_stats_fixture(spark):
    row = E.queries()["partition_stats"](spark, SF_SMALL).first()
    total = spark.read.parquet(os.path.join(SF_SMALL, "lineitem.parquet")).count()
    assert (row["partitions"], row["row_count"], row["split_keys"]) == (8, total, 0)


EXECUTING = {"tune_rf", "train_rf", "score_clients", "feature_importance", "feature_vectors",
             "stream_score", "write_chunks", "clean_rows", "ingest_table", "write_tsv",
             "load_clients", "stream_source", "stream_group_agg", "stream_sliding",
             "stream_watermark", "winsorize_iqr", "binary_metrics", "string_index",
             "standard_scale", "exact_median_by_group", "stream_missing_time", "winsorize_sketch", "bucketed_group",
             "observed_write", "shared_scan", "stream_state", "stream_upsert", "stream_feed", "stream_memory", "stream_concurrent", "csv_table", "load_renamed",
             "tree_split", "tree_split_stream", "tree_importance"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - EXECUTING))
def test_no_python_evaluation_in_plans(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rest_works_without_the_training_data_package(tmp_path):
    """The entry imports and lists the other queries when clientlens/llm and
    corpus_pipeline.py are deleted."""
    import shutil
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') or k == 'pipeline' for k in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert out.stdout.split() == [str(len(registry.queries())), "False"], out.stderr
