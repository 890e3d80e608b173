"""Random-forest propensity model: training, tuning, importances, scoring."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientlens.ml.features import feature_pipeline, fit_preparation, hash_bucket, slot_names
from clientlens.ml.forest import COUNT, CountedRows, grow
from clientlens.session import parallelism as session_parallelism

#: Training rows of a partition, and partitions at most (see ``layout``).
TREE_ROWS = 20_000
MOST_PARTITIONS = 20_000
#: Partitions of training rows that a task counts before the counts of all meet.
COUNT_PARTS = 25


def random_forest(num_trees: int = 100, max_depth: int = 5, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed)


def tree_partitions(rows: int) -> int:
    """Partitions for so many training rows: they follow the data alone."""
    return min(MOST_PARTITIONS, max(1, -(-rows // TREE_ROWS)))


def layout(df: DataFrame, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Rows in ``partitions`` partitions by a hash of the key (default: of all
    columns), sorted within each. Trees sample rows by partition and place,
    so the same rows give the same forest whatever files, cores or
    partitions they came from. By default the rows are counted and
    ``tree_partitions`` of them made, so that the tasks grow with the table."""
    k = F.col(key) if key else F.xxhash64(*df.columns)
    partitions = partitions or tree_partitions(df.count())
    return (df.withColumn("__layout", k).repartition(partitions, "__layout")
            .sortWithinPartitions("__layout").drop("__layout"))


def train_rf(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str],
             label_col: str = "y", num_trees: int = 100, max_depth: int = 5,
             seed: int = 42, partitions: int | None = None, key: str | None = None,
             clip_cols: Sequence[str] = (), sentinel_cols: Sequence[str] = ()) -> tuple[PipelineModel, float]:
    """Fit preparation, features and forest; returns the model, which takes
    raw rows, and the fit wall time (s). Every fit reads the rows as laid out
    and kept: the source is read twice (count, layout), however few tasks its
    files give."""
    data = layout(train, partitions, key).persist()
    t0 = time.time()
    try:
        prep = fit_preparation(data, num_cols, clip_cols, sentinel_cols)
        pipe = feature_pipeline(cat_cols, num_cols, label_col, random_forest(num_trees, max_depth, seed), prep)
        model = pipe.fit(data)
    finally:
        data.unpersist()
    return model, time.time() - t0


def auc_evaluator(raw_col: str = "rawPrediction") -> BinaryClassificationEvaluator:
    """Area under ROC on the exact curve (``numBins=0``: no down-sampling)."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol=raw_col,
                                         metricName="areaUnderROC", numBins=0)


@dataclass(frozen=True)
class TunedModel:
    """Grid points, their mean AUC over the folds, and the winner refitted on
    all training rows."""

    grid: list[dict[str, int]]
    avg_metrics: list[float]
    best_model: PipelineModel


def tune_rf(train: DataFrame, cat_cols: Sequence[str], num_cols: Sequence[str],
            label_col: str = "y", num_trees: Sequence[int] = (50, 100),
            max_depth: Sequence[int] = (4, 6), folds: int = 3, seed: int = 42,
            parallelism: int = 4, partitions: int | None = None, key: str | None = None,
            clip_cols: Sequence[str] = (), sentinel_cols: Sequence[str] = ()) -> TunedModel:
    """Grid search with k-fold cross validation on AUC.

    Folds are hash buckets of the row key, so they do not depend on
    partitioning, and parts of one kept layout, so the source is read twice.
    Preparation, indexers and scaler are fitted once per fold, on its training
    rows only. A fold grows one forest for all points, with the most trees and to
    the largest depth (``forest``): a point's trees are its first ones, cut off at
    the point's depth, and ``parallelism`` points are evaluated side by side. The
    rows left out are scored once per kind of row, which weighs as many as it has."""
    grid = [{"numTrees": t, "maxDepth": d} for t in num_trees for d in max_depth]
    points = [(p["numTrees"], p["maxDepth"]) for p in grid]
    fold_key = F.col(key) if key else F.xxhash64(*train.columns)
    parts = partitions or tree_partitions(train.count())
    data = layout(train, parts, key).withColumn("__fold", hash_bucket(fold_key, folds, salt="fold:")).persist()
    tasks = min(parts, max(session_parallelism(train.sparkSession), parts // COUNT_PARTS))

    def grown(rows: DataFrame, trees: int, depth: int):
        prep = fit_preparation(rows, num_cols, clip_cols, sentinel_cols)
        stages = feature_pipeline(cat_cols, num_cols, label_col, preparation=prep).fit(rows)
        counted = CountedRows.of(rows, stages, prep, cat_cols, num_cols, label_col)
        return counted, grow(rows, counted, layout, tree_partitions, tasks, trees, depth, seed, "sqrt" if max(num_trees) > 1 else "all")

    aucs: list[list[float]] = []
    try:
        for fold in range(folds):
            counted, forest = grown(data.where(F.col("__fold") != fold).drop("__fold"), max(num_trees), max(max_depth))
            outside = data.where(F.col("__fold") == fold).drop("__fold").coalesce(tasks)
            votes = forest.votes(counted.vectors(counted.groups(outside)), points).persist()
            votes.count()  # the points' curves share the scores
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                aucs.append(list(pool.map(lambda n, votes=votes: auc_roc(votes, f"votes_{n}", COUNT), range(len(grid)))))
            votes.unpersist()
        mean = [sum(a) / folds for a in zip(*aucs)]
        best = grid[mean.index(max(mean))]
        counted, forest = grown(data.drop("__fold"), best["numTrees"], best["maxDepth"])
    finally:
        data.unpersist()
    model = forest.model(train.sparkSession, best["numTrees"], best["maxDepth"])
    random_forest(best["numTrees"], best["maxDepth"], seed)._copyValues(model)
    model._transfer_params_to_java()
    return TunedModel(grid, mean, PipelineModel(stages=[*counted.stages.stages, model]))


def grid_results(spark: SparkSession, tuned: TunedModel,
                 test: DataFrame | None = None) -> DataFrame:
    """One row per grid point: parameters, mean CV AUC, the winner flag and,
    given a held-out ``test`` part, the winner's test AUC (NULL on the other
    rows). As many rows as grid points."""
    best = tuned.avg_metrics.index(max(tuned.avg_metrics))
    test_auc = auc_roc(tuned.best_model.transform(test)) if test is not None else None
    rows = [(p["numTrees"], p["maxDepth"], float(m), i == best, test_auc if i == best else None)
            for i, (p, m) in enumerate(zip(tuned.grid, tuned.avg_metrics))]
    return spark.createDataFrame(
        rows, "num_trees int, max_depth int, avg_auc double, is_best boolean, test_auc double")


def auc_roc(df: DataFrame, score: str = "rawPrediction", weight: str | None = None) -> float:
    """Exact area under the ROC curve (ties count one half); ``weight``: a
    column with the number of rows that a row stands for."""
    evaluator = auc_evaluator(score)
    return (evaluator.setWeightCol(weight) if weight else evaluator).evaluate(df)


def feature_importance(model: PipelineModel, transformed: DataFrame, top: int = 10,
                       rollup: bool = False) -> DataFrame:
    """Top slots of the forest's importance vector, each with its real slot
    name from the assembled vector's metadata (one-hot slots are named
    ``<column>_ohe_<value>``). ``rollup`` sums the slots of each source
    column instead."""
    forest = model.stages[-1]
    names = slot_names(transformed, "features_raw")
    imp = forest.featureImportances.toArray().tolist()
    spark = transformed.sparkSession
    rows = [(names[i] if i < len(names) else f"slot_{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    if rollup:
        src = F.regexp_extract("feature", r"^(.*?)_ohe(_.*)?$", 1)
        df = df.groupBy(F.when(src == "", F.col("feature")).otherwise(src).alias("feature")) \
            .agg(F.sum("importance").alias("importance"))
    order = [F.desc("importance"), F.asc("feature")]
    # at most ``top`` rows reach the rank window
    return (df.orderBy(*order).limit(top)
            .withColumn("rank", F.row_number().over(Window.orderBy(*order))))


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = (),
          digits: int = 3, label_col: str = "y") -> DataFrame:
    """Prediction (int) and confidence = P(class 1) for each row; works on a
    batch or a streaming frame, with the label column absent, NULL or set
    (it is not used for scoring)."""
    src = df.drop(label_col) if label_col in df.columns and label_col not in keep else df
    return model.transform(src).select(
        *keep, F.col("prediction").cast("int").alias("prediction"),
        F.round(vector_to_array("probability")[1], digits).alias("confidence"))
