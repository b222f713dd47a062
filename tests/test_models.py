"""Features, metrics and fitted models."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyfield.operators import metrics, models
from tallyfield.operators.features import feature_columns, feature_stages, fit_features, index_map, slots
from tallyfield.operators.sampling import hash_sample, keyed_split
from tallyfield.plans import models as plans
from tallyfield.sources import local_rows


def test_feature_columns():
    names = ["sex", "age", "bmi", "smokes", "stroke"]
    assert feature_columns(names, "stroke", numeric=["age", "bmi"]) == (["age", "bmi"], ["sex", "smokes"])
    assert feature_columns(names, "stroke", categorical=["sex"]) == (["age", "bmi", "smokes"], ["sex"])
    with pytest.raises(ValueError):
        feature_columns(names, "stroke")


def test_indices_follow_frequency_then_name(spark):
    df = local_rows(spark, [["b"], ["a"], ["c"], ["c"]], "g STRING")
    assert {r.value: r.value_index for r in index_map(df, "g").collect()} == {"c": 0, "a": 1, "b": 2}


def test_one_hot_keeps_the_last_category(spark):
    rows = [(i, g) for i, g in enumerate("FFFFFFFFCCCCCCCEEEEEEBBBBBGGGGHHHAAD")]
    df = local_rows(spark, rows, "id INT, g STRING")
    fitted = feature_stages([], ["g"], one_hot="v").fit(df)
    sizes = fitted.transform(df).select(F.size(vector_to_array("v"))).distinct().collect()
    assert [r[0] for r in sizes] == [8]
    hot = slots(fitted.transform(df), ["g"], "v").distinct()
    assert {r.g: r.slot for r in hot.collect()} == {
        "F": 0, "C": 1, "E": 2, "B": 3, "G": 4, "H": 5, "A": 6, "D": 7}


def test_invalid_rows(spark):
    df = local_rows(spark, [("a", 1.0), ("b", 2.0)], "g STRING, x DOUBLE")
    new = local_rows(spark, [("z", 1.0), ("a", None), ("a", 3.0)], "g STRING, x DOUBLE")
    strict = feature_stages(["x"], ["g"], indexed="v").fit(df)
    with pytest.raises(Exception):
        strict.transform(new).collect()
    skipping = feature_stages(["x"], ["g"], indexed="v", handle_invalid="skip").fit(df)
    assert skipping.transform(new).count() == 1
    keeping = feature_stages(["x"], ["g"], indexed="v", handle_invalid="keep").fit(df)
    assert keeping.transform(new).count() == 3


def test_too_many_categories_are_refused(spark):
    df = local_rows(spark, [[c] for c in "abcdef"], "g STRING")
    with pytest.raises(ValueError):
        fit_features(df, feature_stages([], ["g"], one_hot="v"), ["g"], limit=3)
    with pytest.raises(ValueError):
        index_map(df, "g", limit=3)
    assert fit_features(df, feature_stages([], ["g"], one_hot="v"), ["g"]).transform(df).count() == 6


@pytest.fixture(scope="module")
def predictions(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 1), (2, 0)]
    return local_rows(spark, rows, "y INT, p INT")


def test_confusion_and_accuracy(spark, predictions):
    cells = metrics.confusion_counts(predictions, "y", "p").collect()
    assert sum(r.n for r in cells) == predictions.count()
    matrix = metrics.confusion_matrix(predictions, "y", "p", [0, 1, 2, 3]).orderBy("actual").collect()
    assert [tuple(r) for r in matrix] == [(0, 2, 1, 0, 0), (1, 1, 1, 0, 0), (2, 1, 1, 0, 0), (3, 0, 0, 0, 0)]
    assert tuple(metrics.accuracy(predictions, "y", "p").first()) == (7, 3, 3 / 7)


def test_precision_and_recall_equal_the_built_in_evaluator(spark, predictions):
    rows = {r.label: r for r in metrics.precision_recall(predictions, "y", "p").collect()}
    doubles = predictions.select(F.col("y").cast("double"), F.col("p").cast("double"))
    for label in (0.0, 1.0, 2.0):
        for name in ("precision", "recall"):
            evaluator = MulticlassClassificationEvaluator(
                labelCol="y", predictionCol="p", metricName=f"{name}ByLabel", metricLabel=label)
            assert rows[label][name] == pytest.approx(evaluator.evaluate(doubles))


def test_label_that_is_only_predicted_has_no_recall(spark):
    df = local_rows(spark, [(0, 5), (0, 0)], "y INT, p INT")
    row = {r.label: r for r in metrics.precision_recall(df, "y", "p").collect()}[5.0]
    assert (row.precision, row.recall) == (0.0, None)


def test_wrong_rows(spark):
    df = local_rows(spark, [(0, 1, 0.7), (1, 1, 0.99), (1, 0, 0.29)], "y INT, p INT, q DOUBLE")
    assert tuple(metrics.misclassified_range(df, "y", "p", "q").first()) == (2, 0.7, 0.29)


def test_majority_vote_of_a_long_table(spark):
    rows = [(1, 0.0), (1, 0.0), (1, 1.0), (2, 2.0), (2, 1.0)]
    votes = models.majority_vote(local_rows(spark, rows, "id INT, p DOUBLE"), "id", "p")
    assert {r.id: r.vote for r in votes.collect()} == {1: 0.0, 2: 1.0}


def test_full_grids():
    assert len(models.logistic_search("y", "v")[1]) == 15
    assert len(models.tree_search("y", "v")[1]) == 32
    tree, grid = models.tree_search(
        "y", "v", models.MULTI_DEPTH, models.MULTI_MIN_INSTANCES, maxBins=models.MULTI_MAX_BINS)
    assert len(grid) == 33 and tree.getMaxBins() == 38 and tree.getSeed() == 1


@pytest.fixture(scope="module")
def planted(spark, small_sf):
    train, held_out = plans.prepared(spark, small_sf)
    return train.persist(), held_out.persist()


def tree_cv(train):
    return models.cross_validate(
        train, models.tree_search("label", "features_dt", (2, 6), (1, 4)), "label", plans.ROW_KEY, folds=3)


def test_cross_validation_does_not_depend_on_partitioning(spark, planted):
    train, _ = planted
    one, two = tree_cv(train), tree_cv(train.repartition(5))
    assert one.avgMetrics == two.avgMetrics
    summary = models.cv_summary(spark, one)
    assert summary.columns == ["maxDepth", "minInstancesPerNode", "accuracy"] and summary.count() == 4
    assert models.cv_best(spark, one).first().accuracy == max(one.avgMetrics)


def test_a_bounded_search_validates_all_rows(spark, planted):
    train, _ = planted
    search = models.tree_search("label", "features_dt", (2, 6), (1,))
    found = models.cross_validate(train, search, "label", plans.ROW_KEY, folds=2, fit_rows=300)
    sizes = [r["count"] for r in train.groupBy(models.hash_bucket(plans.ROW_KEY, 2, models.SEED)).count().collect()]
    assert sum(sizes) == train.count() > 1000
    # A mean of shares of whole folds: times both sizes it is a whole number.
    for accuracy in found.avgMetrics:
        whole = 2 * accuracy * sizes[0] * sizes[1]
        assert whole == pytest.approx(round(whole), abs=1e-4) and accuracy > 0.5
    every = models.cross_validate(train, search, "label", plans.ROW_KEY, folds=2, fit_rows=10**9)
    full = models.cross_validate(train, search, "label", plans.ROW_KEY, folds=2)
    assert every.avgMetrics == full.avgMetrics and found.avgMetrics != full.avgMetrics


def test_a_small_sample_of_many_rows_is_not_empty(spark, planted):
    many = spark.range(400_000, numPartitions=4)
    assert keyed_split(many, ["id"], 16 / 400_000, seed=11)[0].count() == 0
    assert 4 <= many.filter(hash_sample(["id"], 16, 400_000, seed=11)).count() <= 40
    assert many.filter(hash_sample(["id"], 10**6, 400_000)).count() == 400_000
    folded = many.select((F.col("id") % 3).cast("double").alias("label"), "id", F.lit(0).alias("x"))
    stages = feature_stages(["x"], [], indexed="v")
    rows = stages.fit(folded).transform(folded)
    search = models.tree_search("label", "v", (2,), (1,))
    assert len(models.cross_validate(rows, search, "label", ["id"], folds=2, fit_rows=16).avgMetrics) == 1


def test_models_learn_the_planted_rule(spark, planted):
    train, held_out = planted
    most = held_out.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    lr = models.cross_validate(
        train, models.logistic_search("label", "features_lr", (0.001,), (0.0,)), "label",
        plans.ROW_KEY, folds=3)
    tree = tree_cv(train)
    for model in (lr, tree):
        scored = models.score(model.bestModel, held_out, ["label"])
        assert metrics.accuracy(scored, "label", "prediction").first().accuracy > most + 0.1
        total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
        low, high = scored.agg(F.min(total), F.max(total)).first()
        assert low == pytest.approx(1.0) and high == pytest.approx(1.0)
    best = max(tree.avgMetrics)
    assert 0.8 < best <= 0.95
    assert models.choose_model({"lr": lr, "tree": tree}) in ("lr", "tree")

    names = [*plans.NUMERIC, *plans.CATEGORICAL]
    shares = {r.feature: r.importance for r in models.importances(spark, tree.bestModel, names).collect()}
    assert sum(shares.values()) == pytest.approx(1.0)
    assert max(shares, key=shares.get) == "l_quantity"
    with pytest.raises(ValueError):
        models.importances(spark, tree.bestModel, names[:2])
    leaves = models.leaf_counts(tree.bestModel, held_out).collect()
    assert sum(r.n for r in leaves) == held_out.count()
    assert len({r.leaf for r in leaves}) == len(leaves)


def test_index_map_of_many_values(spark):
    df = spark.range(40_000).selectExpr("concat('v', lpad(id % 20000, 5, '0')) AS g").unionAll(
        spark.range(7).selectExpr("'v00042' AS g"))
    found = index_map(df, "g").orderBy("value_index").collect()
    assert len(found) == 20_000 and [r.value_index for r in found] == list(range(20_000))
    assert found[0].value == "v00042" and [r.value for r in found[1:]] == sorted(r.value for r in found[1:])
