"""Propensity-model analyses on the ``orders`` fixture, and metric checks on
rule-based predictions over ``lineitem``.

Client roles on orders: categorical ``o_orderpriority`` and order ``month``;
numeric ``o_totalprice`` (clipped to IQR fences fitted on the training part;
missing in every 97th order), ``order_year`` and ``contact_gap``
(``o_custkey mod 10``, 0 written as the ``-1`` sentinel); label ``y`` = 'yes'
when ``o_orderstatus = 'F'``. The split is an 80/20 hash of ``o_orderkey``.
Every key fits what it needs itself; nothing is kept between calls.
"""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens import ml
from clientlens import streaming as st
from clientlens.functions.columns import month_name
from clientlens.sources import read_table

CAT_COLS = ["o_orderpriority", "month"]
NUM_COLS = ["o_totalprice", "order_year", "contact_gap"]
KEY = "o_orderkey"
FIT = {"key": KEY, "clip_cols": ["o_totalprice"], "sentinel_cols": ["contact_gap"]}


def clients(df: DataFrame) -> DataFrame:
    """Orders seen as client contacts (works on batch and streaming frames)."""
    gap = F.pmod(F.col("o_custkey"), F.lit(10)).cast("int")
    return df.select(
        KEY, "o_orderpriority", month_name("o_orderdate").alias("month"),
        F.when(F.col(KEY) % 97 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.year("o_orderdate").alias("order_year"),
        F.when(gap == 0, F.lit(-1)).otherwise(gap).alias("contact_gap"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("y"))


def split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ml.hash_split(clients(read_table(spark, sf_dir, "orders")), KEY)


def fitted_model(spark: SparkSession, sf_dir: str, num_trees: int = 100, max_depth: int = 5):
    return ml.train_rf(split(spark, sf_dir)[0], CAT_COLS, NUM_COLS, "y", num_trees, max_depth,
                       seed=42, **FIT)[0]


def feature_vectors(spark, sf_dir):
    """Fitted feature stages (preparation with exact quartiles, indexers,
    one-hot, assembler, scaler) applied to every order: key, label and the
    scaled vector in millionths, slot by slot."""
    train, test = split(spark, sf_dir)
    prep = ml.fit_preparation(train, NUM_COLS, FIT["clip_cols"], FIT["sentinel_cols"], exact=True)
    model = ml.feature_pipeline(CAT_COLS, NUM_COLS, "y", preparation=prep).fit(train)
    millionths = F.transform(vector_to_array("features"), lambda x: F.round(x * 1e6).cast("bigint").cast("string"))
    return model.transform(train.unionByName(test)).select(
        KEY, F.col("label").cast("int").alias("label"), F.array_join(millionths, ",").alias("features"))


def string_index(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders").select(KEY, "o_orderpriority")
    model = ml.string_indexer(["o_orderpriority"], ["priority_index"]).fit(od)
    return model.transform(od)


def dictionary_index(spark, sf_dir):
    """Many-valued category encoded by a distributed dictionary, fitted on
    four fifths of the orders; values that only the rest has get the extra index."""
    od = read_table(spark, sf_dir, "orders").select(KEY, F.pmod(F.col("o_custkey"), F.lit(1000)).alias("o_clerk_group"))
    known = ml.dictionary(od.where(F.col(KEY) % 5 > 0), "o_clerk_group", "clerk_index")
    return ml.dictionary_index(od, "o_clerk_group", known, "clerk_index")


def _one_split(spark, sf_dir):
    """Labelled orders and a model of one tree of one split on all training
    rows, year and gap as features. 'yes' is seven in ten order keys from 1998 on, two before
    (a split whose sides predict the same would be pruned)."""
    orders = clients(read_table(spark, sf_dir, "orders")).withColumn("y", F.when(
        F.col(KEY) % 10 < F.when(F.col("order_year") >= 1998, 7).otherwise(2), "yes").otherwise("no"))
    train, _ = ml.hash_split(orders, KEY)
    prep = ml.fit_preparation(train, NUM_COLS[1:], sentinel_cols=FIT["sentinel_cols"])
    tree = ml.random_forest(1, 1).setBootstrap(False).setFeatureSubsetStrategy("all")
    return orders, ml.feature_pipeline([], NUM_COLS[1:], "y", tree, prep).fit(ml.layout(train, key=KEY))


def tree_split(spark, sf_dir):
    """Prediction and confidence of every order by the tree of one split,
    which SQL works out by trying each threshold."""
    orders, model = _one_split(spark, sf_dir)
    return ml.score(model, orders, keep=[KEY], digits=6)


def tree_split_stream(spark, sf_dir):
    """The same scores of orders that arrive as a file stream."""
    _, model = _one_split(spark, sf_dir)
    schema = read_table(spark, sf_dir, "orders").schema
    stream = st.stream_source(spark, f"{sf_dir.rstrip('/')}/orders*.parquet", schema)
    return st.run_append(ml.score(model, clients(stream).drop("y"), keep=[KEY], digits=6), "tree_split_stream")


def tree_importance(spark, sf_dir):
    """Importance of each feature in the tree of one split: all of it is the
    split feature's, which SQL finds by trying each threshold."""
    orders, model = _one_split(spark, sf_dir)
    return ml.feature_importance(model, model.transform(orders), top=2)


def standard_scale(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    vec = VectorAssembler(inputCols=["l_quantity"], outputCol="v").transform(li)
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=False, withStd=True) \
        .fit(vec).transform(vec)
    return scaled.select("l_orderkey", "l_linenumber",
                         F.round(vector_to_array("s")[0], 6).alias("quantity_scaled"))


def hash_split(spark, sf_dir):
    od = read_table(spark, sf_dir, "orders")
    return (od.groupBy(F.when(ml.split_column(KEY), "train").otherwise("test").alias("part"))
            .agg(F.count(F.lit(1)).alias("row_count")))


def train_rf(spark, sf_dir):
    train, test = split(spark, sf_dir)
    model, _ = ml.train_rf(train, CAT_COLS, NUM_COLS, "y", seed=42, **FIT)
    scored = model.transform(ml.layout(test, key=KEY)).select("label", "prediction", "rawPrediction").persist()
    metrics = ml.class_metrics(scored).first()  # one row
    auc = ml.auc_roc(scored)
    scored.unpersist()
    forest = model.stages[-1]
    return spark.createDataFrame(
        [(forest.getNumTrees, forest.getMaxDepth(), forest.numFeatures, round(auc, 6), *metrics)],
        "num_trees int, max_depth int, num_features int, test_auc double, accuracy double, "
        "weighted_precision double, weighted_recall double, weighted_f1 double")


def score_clients(spark, sf_dir):
    """Every order scored with the trained model, summed up per priority:
    rows, distinct keys, and rows whose prediction and confidence disagree or
    are out of range."""
    model = fitted_model(spark, sf_dir)
    orders = ml.layout(clients(read_table(spark, sf_dir, "orders")), key=KEY)
    scored = ml.score(model, orders, keep=[KEY, "o_orderpriority"], digits=6)
    sure = F.col("confidence")
    bad = (~sure.between(0, 1) | ~F.col("prediction").isin(0, 1) | sure.isNull()
           | ((F.col("prediction") == 1) & (sure < 0.499999)) | ((F.col("prediction") == 0) & (sure > 0.500001)))
    return scored.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_scored"), F.countDistinct(KEY).alias("n_keys"), F.count_if(bad).alias("n_invalid"))


def tune_rf(spark, sf_dir):
    """Grid search with 3-fold CV on the training part, the winner scored on
    the test part: the grid's shape and whether its figures are sound."""
    train, test = split(spark, sf_dir)
    tuned = ml.tune_rf(train, CAT_COLS, NUM_COLS, "y", folds=3, seed=42, parallelism=4, **FIT)
    grid = ml.grid_results(spark, tuned, ml.layout(test, key=KEY))
    return grid.select("num_trees", "max_depth", F.col("avg_auc").between(0, 1).alias("auc_in_range"),
                       (F.col("is_best") == F.col("test_auc").isNotNull()).alias("best_is_tested"))


def feature_importance(spark, sf_dir):
    """Importances per source column: slots, whether their share is in range,
    and the sum over all columns."""
    model = fitted_model(spark, sf_dir)
    train, _ = split(spark, sf_dir)
    # transform() is lazy: only the output schema (slot metadata) is used
    slots = ml.feature_importance(model, model.transform(train), top=10_000)
    source = F.regexp_extract("feature", r"^(.*?)_ohe(_.*)?$", 1)
    return (slots.groupBy(F.when(source == "", F.col("feature")).otherwise(source).alias("feature"))
            .agg(F.count(F.lit(1)).alias("n_slots"), F.sum("importance").between(0, 1 + 1e-9).alias("in_range"))
            .withColumn("total", slots.agg(F.round(F.sum("importance"), 6)).scalar()))


def stream_score(spark, sf_dir):
    """Orders that arrive as a file stream, scored into a file sink (append,
    exactly-once), held against batch scoring with the same model."""
    model = fitted_model(spark, sf_dir)
    path = f"{sf_dir.rstrip('/')}/orders*.parquet"
    orders = read_table(spark, sf_dir, "orders")
    stream = st.stream_source(spark, path, orders.schema, max_files_per_trigger=st.FILES_PER_TRIGGER)
    streamed = st.run_append(ml.score(model, clients(stream).drop("y"), keep=[KEY]), "stream_score")
    batch = ml.score(model, clients(orders), keep=[KEY]).select(
        F.col(KEY).alias("key"), F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    both = streamed.join(batch, F.col(KEY) == F.col("key"), "full_outer")
    return both.agg(
        F.count(KEY).alias("n_streamed"), F.count("key").alias("n_batch"), F.countDistinct(KEY).alias("n_keys"),
        F.count_if(~F.col("prediction").eqNullSafe(F.col("p")) | ~F.col("confidence").eqNullSafe(F.col("c"))).alias("n_different"))


# Rule predictions for the metric checks: label 1 for returned items,
# predicted 1 when the discount is at least 5%, raw score = the discount.
def _rule_predictions(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"),
        F.when(F.col("l_discount") >= 0.05, 1.0).otherwise(0.0).alias("prediction"),
        F.col("l_discount").alias("score"))


def confusion_matrix(spark, sf_dir):
    return ml.confusion_matrix(_rule_predictions(spark, sf_dir), name="row_count")


def class_metrics(spark, sf_dir):
    return ml.class_metrics(_rule_predictions(spark, sf_dir))


def binary_metrics(spark, sf_dir):
    return ml.binary_metrics(_rule_predictions(spark, sf_dir), "score")


QUERIES = {
    "string_index": string_index,
    "dictionary_index": dictionary_index,
    "tree_split": tree_split,
    "tree_split_stream": tree_split_stream,
    "tree_importance": tree_importance,
    "standard_scale": standard_scale,
    "confusion_matrix": confusion_matrix,
    "class_metrics": class_metrics,
    "binary_metrics": binary_metrics,
    "hash_split": hash_split,
    "feature_vectors": feature_vectors,
    "train_rf": train_rf,
    "score_clients": score_clients,
    "feature_importance": feature_importance,
    "tune_rf": tune_rf,
    "stream_score": stream_score,
}
