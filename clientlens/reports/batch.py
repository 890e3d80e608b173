"""The batch analyses of a client-contact table, as one report.

Three groups of analyses over the 17-column client table: the DataFrame
analyses, the SQL analyses, and the five map/reduce jobs (which read the raw
text, drop short rows, trim fields and parse numbers per metric). Every
entry is a lazy DataFrame; ``write_report`` materialises them.

    python -m clientlens.reports.batch --input bank.csv --out report/
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import functions as fn
from clientlens import operators as ops
from clientlens.reports.common import (
    add_io_args, session_from_args, stage, stage_root, write_report,
)
from clientlens.sources import clean_rows, load_clients, metric_rows, read_raw_rows


def _yes(c: str) -> Column:
    return F.col(c) == "yes"


def dataframe_analyses(df: DataFrame) -> dict[str, DataFrame]:
    with_groups = df.withColumns({"age_group": fn.age_group("age"),
                                  "quarter": fn.quarter_of("month")})
    return {
        "summary_statistics": ops.describe_numeric(
            df, ["age", "balance", "duration", "campaign", "pdays", "previous"]),
        "high_balance_clients": ops.total_count(df.where(F.col("balance") > 1000),
                                                "high_balance_clients"),
        "month_quarter": ops.month_quarter(df, "month"),
        "balance_and_median_age_by_job": ops.avg_median_by_group(
            df, "job", "balance", "age", "avg_balance", "median_age"),
        "subscribed_by_marital": ops.filtered_count_by_group(df, _yes("y"), "marital"),
        "clients_by_age_group": ops.count_by(with_groups, "age_group"),
        "subscription_rate_by_education": ops.rate_by_group(
            df, "education", _yes("y"), "total", "subscribed", "subscription_rate_pct"),
        "top3_jobs_by_default_rate": ops.topk_rate(
            df, "job", _yes("default"), 3, "total", "defaults", "default_rate_pct"),
        "string_features": df.select(
            "job", "marital", fn.joined("_", "job", "marital").alias("job_marital"),
            "contact", fn.upper("contact").alias("contact_upper")),
        "clients_by_job": ops.count_by(df, "job", order_by_count=True),
        "avg_balance_by_quarter": ops.avg_by_quarter(df, "month", "balance", "avg_balance"),
        "high_balance_subscribers_by_education": ops.above_avg_by_group(
            df, "balance", "education", _yes("y")),
        "subscription_rate_by_contact": ops.rate_by_group(
            df, "contact", _yes("y"), "total", "subscribed", "subscription_rate_pct"),
        "default_counts": ops.count_by(df, "default"),
    }


def sql_analyses(df: DataFrame) -> dict[str, DataFrame]:
    return {
        "total_clients": ops.total_count(df, "total_clients"),
        "preview": ops.preview(df, 10),
        "married_with_loan": df.where((F.col("marital") == "married") & _yes("loan")),
        "top10_balances": ops.top_k(df.select("job", "marital", "balance"), 10,
                                    F.desc("balance"), F.asc("job"), F.asc("marital")),
        "avg_age_by_job": ops.avg_by_group(df, "job", "age", "avg_age", None),
        "defaults_by_education": ops.filtered_count_by_group(df, _yes("default"), "education",
                                                             "default_count"),
        "top5_jobs_by_balance_with_rate": ops.topk_avg_with_rate(
            df, "job", "balance", _yes("y"), 5, "avg_balance", "subscription_rate_pct"),
        "busiest_month": ops.busiest(df, "month", _yes("y")),
        "age_balance_corr": ops.corr(df, "age", "balance", "age_balance_corr"),
        "monthly_contact_volume": ops.monthly_trend(df, "month", "contact_volume", align=False),
        "balance_spread_by_education": ops.spread_by_group(df, "education", "balance"),
        "subscription_by_previous_outcome": ops.rate_by_group(
            df, "poutcome", _yes("y"), "total_clients", "subscribed_clients",
            "subscription_rate_pct"),
        "call_duration_by_subscription": ops.avg_by_group(
            df.withColumnRenamed("y", "subscription_status"), "subscription_status",
            "duration", "avg_call_duration", None),
    }


def mapreduce_analyses(clean: DataFrame) -> dict[str, DataFrame]:
    """The five map/reduce jobs over cleaned text rows (``clean_rows``)."""
    balance = metric_rows(clean, ["balance"], keep=["job"])
    duration = metric_rows(clean, ["duration"], keep=["poutcome"])
    ages = metric_rows(clean, ["age", "balance"], cast={"age": fn.parse_int("age")})
    return {
        "mr1_avg_balance_by_job": ops.avg_by_group(balance, "job", "balance", "avg_balance"),
        "mr2_housing_by_education": ops.count_by(clean, ["education", "housing"]),
        "mr3_contacts_by_month_and_status": ops.month_status_crosstab(clean, "month", "y"),
        "mr4_duration_by_outcome": ops.avg_by_group(duration, "poutcome", "duration",
                                                    "avg_duration"),
        "mr5_balance_by_age_decade": ops.band_stats(ages, fn.decade("age"), "balance", "age_band",
                                                    "avg_balance"),
        "housing_pivot": ops.pivot_counts(clean, "education", "housing", ["yes", "no"]),
    }


def batch_report(spark: SparkSession, path: str, staged: bool = True,
                 stage_dir: str | None = None) -> dict[str, DataFrame]:
    """Every batch analysis of the client CSV at ``path``. With ``staged``
    the typed table and the cleaned text rows are first written once as
    Parquet (see ``stage``)."""
    df = load_clients(spark, path)
    clean = clean_rows(read_raw_rows(spark, path))
    if staged:
        root = stage_root(spark, stage_dir)
        df = stage(df, f"{root}/typed")
        clean = stage(clean, f"{root}/clean_text")
    out = {**dataframe_analyses(df), **sql_analyses(df)}
    out.update(mapreduce_analyses(clean))
    return out


def main(argv: list[str] | None = None) -> None:
    parser = add_io_args(argparse.ArgumentParser(description=__doc__.splitlines()[0]))
    args = parser.parse_args(argv)
    spark = session_from_args(args)
    write_report(batch_report(spark, args.input, not args.no_stage, args.stage_dir),
                 args.out, args.format,
                 args.parallel_writes)


if __name__ == "__main__":
    main()
