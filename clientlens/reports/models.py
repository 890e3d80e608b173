"""The propensity-model report of a client-contact table.

An 80/20 hash split, a random forest whose pipeline also prepares the rows
(sentinel pdays -> 0, missing numbers -> median, balance clipped to IQR fences,
all fitted on the training part), its test metrics, confusion matrix and
feature importances, and optionally the grid search.

    python -m clientlens.reports.models --input bank.csv --out report/ [--tune]
"""

from __future__ import annotations

import argparse

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import ml
from clientlens import operators as ops
from clientlens.reports.common import (
    add_io_args, session_from_args, stage, stage_root, write_report,
)
from clientlens.schema import CATEGORICAL_COLS, NUMERIC_COLS, TARGET_COL
from clientlens.sources import load_clients


def with_key(df: DataFrame) -> DataFrame:
    """A row key for the hash split: a hash of every input column, so the
    split does not depend on file order or partitioning."""
    return df.withColumn("client_key", F.xxhash64(*df.columns))


def model_report(spark: SparkSession, path: str, num_trees: int = 100, max_depth: int = 5,
                 tune: bool = False, partitions: int | None = None, staged: bool = True,
                 stage_dir: str | None = None) -> tuple[dict[str, DataFrame], PipelineModel]:
    df = with_key(load_clients(spark, path))
    if staged:  # the fit scans the data many times: read Parquet, not text
        df = stage(df, f"{stage_root(spark, stage_dir)}/keyed")
    train, test = ml.hash_split(df, "client_key")
    args = dict(key="client_key", clip_cols=["balance"], sentinel_cols=["pdays"], partitions=partitions)
    model, seconds = ml.train_rf(train, CATEGORICAL_COLS, NUMERIC_COLS, TARGET_COL, num_trees,
                                 max_depth, **args)
    scored = model.transform(test)
    metrics = ml.class_metrics(scored).withColumns({
        "auc_roc": F.lit(ml.auc_roc(scored)),
        "train_rows": F.lit(train.count()), "test_rows": F.lit(test.count()),
        "fit_seconds": F.lit(round(seconds, 3))})
    out = {
        "missing_values": ops.null_counts(df),
        "split_sizes": df.groupBy(F.when(ml.split_column("client_key"), "train")
                                  .otherwise("test").alias("part")).count(),
        "test_metrics": metrics,
        "confusion_matrix": ml.confusion_matrix(scored),
        "feature_importance": ml.feature_importance(model, scored, top=10),
        "feature_importance_by_column": ml.feature_importance(model, scored, top=20, rollup=True),
        "test_predictions": ml.score(model, test, keep=["client_key", "job", "balance"]),
    }
    if tune:
        cv = ml.tune_rf(train, CATEGORICAL_COLS, NUMERIC_COLS, TARGET_COL, **args)
        out["grid_search"] = ml.grid_results(spark, cv, test)
    return out, model


def main(argv: list[str] | None = None) -> None:
    parser = add_io_args(argparse.ArgumentParser(description=__doc__.splitlines()[0]))
    parser.add_argument("--tune", action="store_true", help="also run the 2x2 grid, 3-fold CV")
    parser.add_argument("--tree-partitions", type=int, default=None,
                        help="partitions of the training rows; the forest depends on it (default: by their number)")
    parser.add_argument("--model-out", default=None, help="save the fitted pipeline here")
    args = parser.parse_args(argv)
    spark = session_from_args(args)
    results, model = model_report(spark, args.input, tune=args.tune,
                                  partitions=args.tree_partitions,
                                  staged=not args.no_stage, stage_dir=args.stage_dir)
    write_report(results, args.out, args.format, args.parallel_writes)
    if args.model_out:
        model.write().overwrite().save(args.model_out)


if __name__ == "__main__":
    main()
