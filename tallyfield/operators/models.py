"""Classifier tuning, scoring and inspection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.operators.sampling import hash_bucket, hash_sample
from tallyfield.sources.generators import local_rows

# Full search grids.
BINARY_REG = (0.0001, 0.001, 0.01, 0.1, 1.0)
MULTI_REG = (0.00001, 0.0001, 0.001, 0.01, 0.1)
ELASTIC_NET = (0.0, 0.5, 1.0)
BINARY_DEPTH = (2, 4, 6, 8, 10, 12, 14, 16)
BINARY_MIN_INSTANCES = (4, 8, 16, 32)
MULTI_DEPTH = (4, 6, 8, 10, 12, 14, 16, 18, 20, 22, 24)
MULTI_MIN_INSTANCES = (1, 2, 4)
FOLDS = 5
SEED = 1
MULTI_MAX_BINS = 38

FOLD = "cv_fold"
FOLD_KEY = "cv_key"
FIT_SEED = 11
FIT_PARTITION_ROWS = 4_000


def logistic_search(
    label: str, features: str, reg: Sequence[float] = BINARY_REG,
    elastic_net: Sequence[float] = ELASTIC_NET, **params,
) -> tuple[LogisticRegression, list]:
    """(estimator, grid) for logistic regression, binary or multinomial by the label."""
    lr = LogisticRegression(labelCol=label, featuresCol=features, **params)
    grid = ParamGridBuilder().addGrid(lr.regParam, reg).addGrid(lr.elasticNetParam, elastic_net)
    return lr, grid.build()


def tree_search(
    label: str, features: str, depth: Sequence[int] = BINARY_DEPTH,
    min_instances: Sequence[int] = BINARY_MIN_INSTANCES, **params,
) -> tuple[DecisionTreeClassifier, list]:
    """(estimator, grid) for a decision tree. ``maxBins`` must cover the largest category set."""
    tree = DecisionTreeClassifier(labelCol=label, featuresCol=features, **{"seed": SEED, **params})
    grid = (ParamGridBuilder().addGrid(tree.maxDepth, depth)
            .addGrid(tree.minInstancesPerNode, min_instances))
    return tree, grid.build()


class BoundedCrossValidator(CrossValidator):
    """Fits each fold's settings on about ``fit_rows`` of its training rows, picked by a hash of the
    row key. Every validation row is scored, and the best setting is fitted on all rows."""

    fit_rows = 0

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        counts = {r[FOLD]: r["count"] for r in dataset.groupBy(FOLD).count().collect()}
        pairs = []
        for fold in range(self.getNumFolds()):
            total = sum(counts.values()) - counts.get(fold, 0)
            training = dataset.filter(
                (F.col(FOLD) != fold) & hash_sample([FOLD_KEY], self.fit_rows, total, FIT_SEED))
            # A fit is many small jobs: its rows, which are few whatever the input, take few tasks.
            parts = math.ceil(min(self.fit_rows, total) / FIT_PARTITION_ROWS)
            training = training.repartition(max(1, parts), FOLD_KEY)
            if fold not in counts or training.isEmpty():
                raise ValueError(f"fold {fold} has no rows to fit or to validate on")
            pairs.append((training, dataset.filter(F.col(FOLD) == fold)))
        return pairs


def cross_validate(
    df: DataFrame, search: tuple, label: str, keys: Sequence[str], folds: int = FOLDS,
    parallelism: int = 4, seed: int = SEED, fit_rows: int | None = None,
) -> CrossValidatorModel:
    """k-fold search by accuracy. The fold follows from the row key, so partitioning, retries and
    cluster size do not change which rows a fold holds. ``fit_rows`` bounds the rows that a setting
    is fitted on; accuracies are always those of all rows."""
    estimator, grid = search
    validator = (CrossValidator if fit_rows is None else BoundedCrossValidator)(
        estimator=estimator, estimatorParamMaps=grid, evaluator=accuracy_evaluator(label),
        numFolds=folds, foldCol=FOLD, parallelism=parallelism,
    )
    columns = [label, estimator.getFeaturesCol(), hash_bucket(keys, folds, seed).alias(FOLD)]
    if fit_rows is not None:
        validator.fit_rows = fit_rows
        columns.append(F.xxhash64(*keys).alias(FOLD_KEY))
    folded = df.select(*columns).persist()
    try:
        return validator.fit(folded)
    finally:
        folded.unpersist()


def fit(df: DataFrame, estimator):
    """Fit on cached rows: training reads them many times, the columns it needs only."""
    rows = df.select(estimator.getLabelCol(), estimator.getFeaturesCol()).persist()
    try:
        return estimator.fit(rows)
    finally:
        rows.unpersist()


def accuracy_evaluator(label: str, prediction: str = "prediction") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy")


def cv_summary(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """One row per setting: its parameter values and its mean accuracy."""
    maps = model.getEstimatorParamMaps()
    names = [param.name for param in maps[0]]
    ddl = ", ".join(f"{name} DOUBLE" for name in [*names, "accuracy"])
    rows = [
        (*[float(value) for value in setting.values()], float(accuracy))
        for setting, accuracy in zip(maps, model.avgMetrics)
    ]
    return local_rows(spark, rows, ddl)


def cv_best(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """One row: the best setting and its accuracy."""
    summary = cv_summary(spark, model)
    settings = [c for c in summary.columns if c != "accuracy"]
    return summary.orderBy(F.col("accuracy").desc(), *settings).limit(1)


def score(model, df: DataFrame, keep: Sequence[str], digits: int | None = None) -> DataFrame:
    """(keep..., probability ARRAY<DOUBLE>, prediction) for every row."""
    probability = vector_to_array("probability")
    if digits is not None:
        probability = F.transform(probability, lambda p: F.round(p, digits))
    return model.transform(df).select(*keep, probability.alias("probability"), "prediction")


def importances(spark: SparkSession, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree over index features, one slot per feature."""
    values = model.featureImportances.toArray()
    if len(values) != len(features):
        raise ValueError("one name per feature slot is needed; use the index-based vector")
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return local_rows(spark, rows, "feature STRING, importance DOUBLE")


def leaf_counts(model, df: DataFrame, leaf: str = "leaf") -> DataFrame:
    """(leaf, prediction, n): how many rows reach each leaf of a tree."""
    scored = model.copy().setLeafCol(leaf).transform(df)
    return scored.groupBy(leaf, "prediction").agg(F.count("*").alias("n"))


def choose_model(models: Mapping[str, CrossValidatorModel]) -> str:
    """Name of the search with the highest cross-validation score; first name wins a tie."""
    return max(sorted(models), key=lambda name: max(models[name].avgMetrics))


def majority_vote(votes: DataFrame, key: str, prediction: str) -> DataFrame:
    """(key, vote) over a long table of predictions; a tie goes to the smallest label.

    Where the votes are columns of one row, ``functions.majority`` needs no shuffle.
    """
    return votes.groupBy(key).agg(F.mode(prediction, deterministic=True).alias("vote"))
