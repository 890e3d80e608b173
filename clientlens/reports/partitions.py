"""The partitioning report of a client-contact table: rows per partition of
a hash repartition by job, grouped analyses, and several global metrics in
one scan.

    python -m clientlens.reports.partitions --input bank.csv --out report/
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import functions as fn
from clientlens import operators as ops
from clientlens.reports.common import (
    add_io_args, session_from_args, stage, stage_root, write_report,
)
from clientlens.sources import load_clients


def partition_report(spark: SparkSession, path: str, num_partitions: int = 8,
                     staged: bool = True, stage_dir: str | None = None) -> dict[str, DataFrame]:
    df = load_clients(spark, path)
    if staged:
        df = stage(df, f"{stage_root(spark, stage_dir)}/typed")
    return {
        "rows_per_partition": ops.partition_stats(df, num_partitions, "job"),
        "avg_balance_by_job": ops.avg_by_group(df, "job", "balance", "avg_balance",
                                               "client_count"),
        "top5_age_bands_with_loan": ops.topk_band_avg(
            df, fn.band5("age"), "balance", F.col("loan") == "yes", 5, "age_band",
            "avg_balance", "loan_count"),
        "avg_balance_by_job_and_education": ops.avg_by_group(
            df, ["job", "education"], "balance", "avg_balance", "count"),
        "global_metrics": ops.global_metrics(df, {
            "avg_balance": ops.mean("balance"),
            "subscribed_pct": ops.hit_rate(F.col("y") == "yes"),
            "default_count": F.count_if(F.col("default") == "yes")}),
    }


def main(argv: list[str] | None = None) -> None:
    parser = add_io_args(argparse.ArgumentParser(description=__doc__.splitlines()[0]))
    parser.add_argument("--partitions", type=int, default=8)
    args = parser.parse_args(argv)
    spark = session_from_args(args)
    write_report(partition_report(spark, args.input, args.partitions, not args.no_stage,
                                  args.stage_dir), args.out, args.format,
                 args.parallel_writes)


if __name__ == "__main__":
    main()
