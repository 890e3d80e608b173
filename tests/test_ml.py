import pytest
from pyspark.sql import functions as F

from clientlens import ml


@pytest.fixture(scope="module")
def clients(spark):
    rows = []
    for i in range(400):
        job = ["admin.", "services", "retired", "student"][i % 4]
        month = ["may", "jun", "jul"][i % 3]
        bal = (i * 37) % 3000 - 200
        pdays = -1 if i % 5 == 0 else i % 40
        y = "yes" if (bal > 1500 and job != "student") or i % 17 == 0 else "no"
        rows.append((i, job, month, bal, pdays, y))
    return spark.createDataFrame(rows, "id long, job string, month string, balance int, "
                                       "pdays int, y string")


def test_label_index_is_alphabetical(spark):
    df = spark.createDataFrame([("yes",)] * 3 + [("no",)], "y string")
    model = ml.feature_pipeline([], [], "y").getStages()[-3]  # label indexer
    out = model.fit(df).transform(df)
    assert {r["y"]: r["label"] for r in out.collect()} == {"no": 0.0, "yes": 1.0}


def test_string_index_frequency_then_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    model = ml.string_indexer(["k"], ["i"]).fit(df)
    assert {r["k"]: r["i"] for r in model.transform(df).collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}
    unseen = spark.createDataFrame([("z",)], "k string")
    assert model.transform(unseen).collect()[0]["i"] == 3.0  # handleInvalid=keep


def test_hash_split_independent_of_partitioning(clients):
    a = {r["id"] for r in ml.hash_split(clients.repartition(1), "id")[0].collect()}
    b = {r["id"] for r in ml.hash_split(clients.repartition(7), "id")[0].collect()}
    assert a == b and 0.7 < len(a) / 400 < 0.9


def test_preparation_sentinel_fences_and_missing_numbers(spark, clients):
    train, test = ml.hash_split(clients, "id")
    prep = ml.fit_preparation(train, ["balance", "pdays"], ["balance"], ["pdays"], exact=True)
    gaps = test.withColumn("balance", F.when(F.col("id") % 3 != 0, F.col("balance")))
    out = prep.stage().transform(gaps)
    assert out.where(F.col("pdays_prepared") == -1).count() == 0
    lo, hi = prep.fences["balance"]
    assert out.where(~F.col("balance_prepared").between(lo, hi)).count() == 0
    missing = out.where(F.col("balance").isNull()).select("balance_prepared").distinct().collect()
    assert [r[0] for r in missing] == [prep.medians["balance"]]


def test_one_missing_number_changes_no_other_row(spark, clients):
    """No NaN through the scaler: the fitted features of all other rows stay."""
    from pyspark.ml.functions import vector_to_array
    prep = ml.fit_preparation(clients, ["balance", "pdays"], ["balance"], ["pdays"])
    model = ml.feature_pipeline(["job", "month"], ["balance", "pdays"], "y", preparation=prep).fit(clients)

    def vectors(df):
        return {r["id"]: r["f"] for r in model.transform(df).select("id", vector_to_array("features").alias("f")).collect()}

    gap = clients.withColumn("balance", F.when(F.col("id") != 7, F.col("balance")))
    before, after = vectors(clients), vectors(gap)
    assert {i for i in before if before[i] != after[i]} <= {7}
    refit = ml.feature_pipeline(["job", "month"], ["balance", "pdays"], "y", preparation=prep).fit(gap)
    values = refit.transform(gap).select(vector_to_array("features").alias("f")).collect()
    assert all(x == x for r in values for x in r["f"])


def test_one_slot_per_known_value(spark, clients):
    model = ml.feature_pipeline(["job", "month"], ["balance"], "y").fit(clients)
    assert ml.slot_names(model.transform(clients)) == [
        *(f"job_ohe_{x}" for x in ("admin.", "retired", "services", "student")), *(f"month_ohe_{x}" for x in ("may", "jul", "jun")), "balance"]
    unseen = clients.limit(1).withColumn("job", F.lit("astronaut")).withColumn("month", F.lit(None).cast("string"))
    assert model.transform(unseen).first()["features_raw"].toArray()[:7].tolist() == [0.0] * 7


def test_same_forest_from_any_partitions(spark, clients):
    train, test = ml.hash_split(clients, "id")
    runs = []
    for n in (1, 4, 8):
        model, _ = ml.train_rf(train.repartition(n), ["job", "month"], ["balance", "pdays"], "y", num_trees=8, max_depth=3,
                               seed=7, key="id", clip_cols=["balance"], sentinel_cols=["pdays"])
        runs.append((model.stages[-1].toDebugString.split("\n", 1)[1], round(ml.auc_roc(model.transform(test)), 9)))
    assert runs[0] == runs[1] == runs[2]


def test_saved_model_prepares_streamed_rows(spark, clients, tmp_dir):
    from pyspark.ml import PipelineModel
    model, _ = ml.train_rf(clients, ["job"], ["balance", "pdays"], "y", num_trees=3, max_depth=2, key="id",
                           clip_cols=["balance"], sentinel_cols=["pdays"])
    model.write().save(f"{tmp_dir}/m")
    loaded = PipelineModel.load(f"{tmp_dir}/m")
    clients.write.parquet(f"{tmp_dir}/in")
    from clientlens import streaming as st
    stream = st.stream_source(spark, f"{tmp_dir}/in", clients.schema)
    streamed = st.run_append(ml.score(loaded, stream, keep=["id"]), "saved_model").collect()
    assert sorted(map(tuple, streamed)) == sorted(map(tuple, ml.score(model, clients, keep=["id"]).collect()))


def test_train_score_importance_metrics(spark, clients):
    train, test = ml.hash_split(clients, "id")
    model, secs = ml.train_rf(train, ["job", "month"], ["balance", "pdays"], "y",
                              num_trees=10, max_depth=3, partitions=4, key="id",
                              clip_cols=["balance"], sentinel_cols=["pdays"])
    assert secs > 0
    scored = model.transform(test)
    auc = ml.auc_roc(scored)
    assert 0.0 <= auc <= 1.0
    imp = ml.feature_importance(model, scored, top=50)
    names = [r["feature"] for r in imp.collect()]
    assert abs(sum(r["importance"] for r in imp.collect()) - 1.0) < 1e-9
    assert len(names) == model.stages[-1].numFeatures
    assert any(n.startswith("job_ohe_") for n in names) and "balance" in names
    rolled = {r["feature"] for r in ml.feature_importance(model, scored, 50, rollup=True).collect()}
    assert rolled == {"job", "month", "balance", "pdays"}
    # scoring with the label missing or NULL
    no_label = ml.score(model, test.drop("y"), keep=["id"])
    null_label = ml.score(model, test.withColumn("y", F.lit(None).cast("string")), keep=["id"])
    assert no_label.count() == test.count() == null_label.count()
    conf = [r["confidence"] for r in no_label.collect()]
    assert all(0.0 <= c <= 1.0 for c in conf)
    cm = ml.confusion_matrix(scored).collect()
    assert sum(r["count"] for r in cm) == test.count()


def test_class_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (2.0, 2.0), (2.0, 0.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = ml.class_metrics(df, digits=None).collect()[0].asDict()
    for name, metric in [("accuracy", "accuracy"), ("weighted_f1", "f1"),
                         ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall")]:
        ev = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert abs(got[name] - ev) < 1e-12, name


def test_tune_rf_grid(spark, clients):
    train, _ = ml.hash_split(clients, "id")
    cv = ml.tune_rf(train, ["job"], ["balance"], "y", num_trees=(5, 10), max_depth=(2,),
                    folds=2, parallelism=2)
    res = ml.grid_results(spark, cv).collect()
    assert len(res) == 2 and sum(r["is_best"] for r in res) >= 1


def test_tune_rf_best_model_test_auc(spark, clients):
    train, test = ml.hash_split(clients, "id")
    cv = ml.tune_rf(train, ["job"], ["balance"], "y", num_trees=(5,), max_depth=(2, 3),
                    folds=2, parallelism=2)
    res = ml.grid_results(spark, cv, test).collect()
    best = [r for r in res if r["is_best"]]
    assert best and all(0.0 <= r["test_auc"] <= 1.0 for r in best)
    assert all(r["test_auc"] is None for r in res if not r["is_best"])


def test_seeded_training_is_repeatable(spark, clients):
    train, test = ml.hash_split(clients, "id")
    train = train.repartition(3).cache()
    runs = []
    for _ in range(2):
        model, _ = ml.train_rf(train, ["job", "month"], ["balance", "pdays"], "y",
                               num_trees=8, max_depth=3, seed=7)
        runs.append(model.stages[-1].featureImportances.toArray().tolist())
    assert runs[0] == runs[1]
    train.unpersist()


def test_layout_follows_the_rows_alone(spark, clients, monkeypatch):
    monkeypatch.setattr(ml.models, "TREE_ROWS", 60)
    train, _ = ml.hash_split(clients, "id")
    want = ml.tree_partitions(train.count())
    assert want > 1 and (ml.tree_partitions(0), ml.tree_partitions(10**12)) == (1, ml.models.MOST_PARTITIONS)
    forests = []
    for parts in (1, 8, 40):
        rows = train.repartition(parts)
        assert ml.layout(rows, key="id").rdd.getNumPartitions() == want
        model, _ = ml.train_rf(rows, ["job"], ["balance"], "y", num_trees=5, max_depth=3, key="id")
        forests.append(model.stages[-1].toDebugString.split("\n", 1)[1])
    assert forests[0] == forests[1] == forests[2]


def counted_reads(spark, df):
    """``df`` and an accumulator of the rows read from it."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), read


def test_training_reads_its_rows_twice(spark, clients):
    train, _ = ml.hash_split(clients, "id")
    rows, read = counted_reads(spark, train)
    ml.train_rf(rows, ["job"], ["balance"], "y", num_trees=3, max_depth=2, key="id", clip_cols=["balance"])
    assert read.value == 2 * train.count()  # count and layout


def test_tuning_reads_its_rows_twice(spark, clients):
    train, _ = ml.hash_split(clients, "id")
    rows, read = counted_reads(spark, train)
    ml.tune_rf(rows, ["job"], ["balance"], "y", num_trees=(2, 4), max_depth=(1, 2), folds=2, key="id")
    assert read.value == 2 * train.count()


def test_nested_grid_agrees_with_separate_forests(spark, clients):
    """The smallest point of a nested grid is a forest of its own; the next
    one's AUC is that of as many trees grown in one go, up to sampling."""
    train, _ = ml.hash_split(clients, "id")
    args = (["job", "month"], ["balance", "pdays"], "y")
    nested = ml.tune_rf(train, *args, num_trees=(20, 40), max_depth=(1, 4), folds=2, parallelism=4, key="id")
    single = {}
    for trees in (20, 40):
        cv = ml.tune_rf(train, *args, num_trees=(trees,), max_depth=(1, 4), folds=2, parallelism=2, key="id")
        single |= {(p["numTrees"], p["maxDepth"]): a for p, a in zip(cv.grid, cv.avg_metrics)}
    for point, auc in zip(nested.grid, nested.avg_metrics):
        other = single[point["numTrees"], point["maxDepth"]]
        assert auc == other if point["numTrees"] == 20 else abs(auc - other) < 0.05


def _grown(train, cat, num, trees, depth, tasks=4, **args):
    from clientlens.ml import forest
    prep = ml.fit_preparation(train, num)
    stages = ml.feature_pipeline(cat, num, "y", preparation=prep).fit(train)
    counted = forest.CountedRows.of(train, stages, prep, cat, num, "y")
    return stages, counted, forest.grow(train, counted, ml.layout, ml.tree_partitions, tasks, trees, depth, **args)


def _patterned(spark, n=6000):
    """Rows of few kinds with a label that follows them, with noise."""
    return spark.range(n).selectExpr(
        "id", "elt(1 + pmod(hash(id), 4), 'a', 'b', 'c', 'd') AS job", "pmod(hash(id, 1), 20) AS balance", "pmod(hash(id, 2), 300) / 7 AS pdays") \
        .selectExpr("*", "IF(pmod(hash(id, 3), 10) < CASE WHEN job = 'a' THEN 8 WHEN balance > 12 AND pdays < 20 THEN 7"
                    " WHEN balance < 3 THEN 6 ELSE 2 END, 'yes', 'no') AS y")


def test_counted_tree_is_sparks_tree(spark):
    """Without a bootstrap and with all features at each node the tree is the
    one that Spark grows on the rows one by one, at each depth."""
    from pyspark.ml.classification import RandomForestClassifier
    train = _patterned(spark).where("pdays * 7 % 10 = 0").cache()  # 30 values: all middles are cuts
    stages, _, grown = _grown(train, ["job"], ["balance", "pdays"], 1, 6, subset="all", bootstrap=False)
    rows = stages.transform(train)
    for depth in (0, 1, 3, 4, 6):
        want = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=1, maxDepth=depth, bootstrap=False,
                                      featureSubsetStrategy="all", seed=1).fit(rows)
        got = grown.model(spark, 1, depth)
        assert got.toDebugString.split("\n", 1)[1] == want.toDebugString.split("\n", 1)[1], depth
        assert abs(got.featureImportances.toArray() - want.featureImportances.toArray()).max() < 1e-9
    assert got.trees[0].depth == 6
    train.unpersist()


def test_counted_forest_is_as_good_as_sparks(spark):
    from pyspark.ml.functions import vector_to_array
    train, test = ml.hash_split(_patterned(spark), "id")
    model, _ = ml.train_rf(train, ["job"], ["balance", "pdays"], "y", num_trees=40, max_depth=5, key="id")
    stages, counted, grown = _grown(train, ["job"], ["balance", "pdays"], 40, 5)
    forest = grown.model(spark, 40, 5)
    scored = forest.transform(stages.transform(test))
    assert abs(ml.auc_roc(scored) - ml.auc_roc(model.transform(test))) < 0.015 and ml.auc_roc(scored) > 0.7
    # kinds of rows, weighed, give the curve of the rows one by one; so does a smaller point
    votes = grown.votes(counted.vectors(counted.groups(test)), [(40, 5), (10, 2)])
    assert votes.agg(F.sum("__n")).first()[0] == test.count() and votes.count() < test.count()
    small = grown.model(spark, 10, 2).transform(stages.transform(test))
    assert abs(ml.auc_roc(votes, "votes_0", "__n") - ml.auc_roc(scored)) < 1e-9
    assert abs(ml.auc_roc(votes, "votes_1", "__n") - ml.auc_roc(small)) < 1e-9
    assert {round(v, 9) for r in votes.collect() for v in [r.votes_0]} == {
        round(r.v, 9) for r in scored.select(vector_to_array("rawPrediction")[1].alias("v")).collect()}


def test_counted_forest_follows_the_rows_alone(spark, monkeypatch):
    monkeypatch.setattr(ml.models, "TREE_ROWS", 500)
    rows = _patterned(spark)
    forests = []
    for parts in (1, 7):
        forest = _grown(ml.layout(rows.repartition(parts), key="id"), ["job"], ["balance"], 6, 4, tasks=parts)[2]
        forests.append(forest.model(spark, 6, 4).toDebugString.split("\n", 1)[1])
    assert forests[0] == forests[1]
    # as many draws as rows, up to chance
    kept = _grown(rows, ["job"], ["balance"], 30, 1)[2].counts[:, 0].sum(axis=1)
    assert abs(kept.mean() - 6000) < 60 and 40 < kept.std() < 120


def test_counting_shrinks_rows_a_tree_cannot_tell_apart(spark, clients):
    """The growth works on kinds of rows: a table twice as large has no more."""
    _, counted, _ = _grown(_patterned(spark), ["job"], ["balance"], 1, 1)
    one, two = counted.groups(_patterned(spark)), counted.groups(_patterned(spark).unionByName(_patterned(spark)))
    assert one.count() == two.count() <= 4 * 20 * 2
    assert two.agg(F.sum("__n")).first()[0] == 12_000


def test_tuned_model_can_be_saved(spark, clients, tmp_dir):
    from pyspark.ml import PipelineModel
    train, test = ml.hash_split(clients, "id")
    best = ml.tune_rf(train, ["job"], ["balance", "pdays"], "y", num_trees=(3, 6), max_depth=(2, 3), folds=2, key="id",
                      clip_cols=["balance"], sentinel_cols=["pdays"]).best_model
    best.write().save(f"{tmp_dir}/tuned")
    loaded = PipelineModel.load(f"{tmp_dir}/tuned")
    assert ml.score(loaded, test, ["id"]).collect() == ml.score(best, test, ["id"]).collect()
    forest = best.stages[-1]
    assert len(forest.trees) == forest.getNumTrees in (3, 6) and forest.getMaxDepth() in (2, 3)


def test_dictionary_equals_string_indexer(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", "a", None, "c", "b", "zz", "a", "é", ""])]
    df = spark.createDataFrame(rows, "id int, v string")
    known = ml.dictionary(df.where("v <> 'zz'"), "v")
    got = {r.id: r["index"] for r in ml.dictionary_index(df, "v", known).collect()}
    model = ml.string_indexer(["v"], ["index"]).fit(df.where("v <> 'zz'"))
    assert got == {r.id: r["index"] for r in model.transform(df).collect()}
    many = spark.range(30_000).selectExpr("cast(id % 10007 as string) as v")
    places = ml.dictionary(many, "v").toPandas()["index"]
    assert sorted(places) == list(range(10_007))
    empty = ml.dictionary(df.where("false"), "v")
    assert {r["index"] for r in ml.dictionary_index(df, "v", empty).collect()} == {0.0}
