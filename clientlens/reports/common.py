"""Shared pieces of the runnable reports: arguments, session, output."""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from clientlens.session import SCALE_CONF, scratch_path


def add_io_args(parser: argparse.ArgumentParser) -> argparse.ArgumentParser:
    parser.add_argument("--input", required=True, help="client CSV file or folder (with header)")
    parser.add_argument("--out", required=True, help="output folder, one sub-folder per result")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    parser.add_argument("--master", default=None,
                        help="Spark master (default: what spark-submit provides)")
    parser.add_argument("--stage-dir", default=None,
                        help="where the input is staged as Parquet (default: under the "
                             "session's checkpoint folder)")
    parser.add_argument("--no-stage", action="store_true",
                        help="read the CSV directly for every analysis")
    parser.add_argument("--parallel-writes", type=int, default=4,
                        help="results written concurrently")
    return parser


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back: later analyses read only
    the columns they need instead of re-parsing every byte of the text, and
    their lineage starts at the written table (a lost executor recomputes
    from it, not from the text). A folder that is there already is an error."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_root(spark: SparkSession, stage_dir: str | None) -> str:
    return stage_dir.rstrip("/") if stage_dir else scratch_path(spark, "stage", "clients")


def session_from_args(args: argparse.Namespace) -> SparkSession:
    builder = SparkSession.builder.appName("clientlens-report")
    if args.master:
        builder = builder.master(args.master)
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def write_report(results: dict[str, DataFrame], out: str, fmt: str = "parquet",
                 parallelism: int = 4) -> list[str]:
    """Write each result to ``out/<name>``. The results are small aggregates
    whose jobs each leave most of the cluster idle, so up to ``parallelism``
    of them are submitted at once from driver threads (Spark schedules
    concurrent jobs side by side)."""
    def write(item: tuple[str, DataFrame]) -> str:
        name, df = item
        target = f"{out.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(target)
        return target

    if parallelism <= 1:
        return [write(item) for item in results.items()]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(write, results.items()))
