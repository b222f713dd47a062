"""Classifier studies: features, searches over the full grids, choice and evaluation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame

from tallyfield.operators import models
from tallyfield.operators.features import feature_columns, feature_stages, fit_features
from tallyfield.sources.schemas import column_names

LR_FEATURES, TREE_FEATURES = "features_lr", "features_dt"


@dataclass(frozen=True)
class Study:
    """A training set: its label, its features and its search grids.

    Rows are told apart by ``keys`` when folds are drawn; without a key column pass all feature
    columns, so that equal rows share a fold.
    """

    label: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    reg: Sequence[float]
    depth: Sequence[int]
    min_instances: Sequence[int]
    max_bins: int = 32
    elastic_net: Sequence[float] = models.ELASTIC_NET

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def fit_features(self, rows: DataFrame, handle_invalid: str = "error") -> PipelineModel:
        """Fitted stages that add both feature vectors; they also prepare new rows."""
        stages = feature_stages(
            self.numeric, self.categorical, LR_FEATURES, TREE_FEATURES, handle_invalid)
        return fit_features(rows, stages, self.categorical)

    def search_logistic(self, prepared: DataFrame, keys: Sequence[str], **options) -> CrossValidatorModel:
        search = models.logistic_search(self.label, LR_FEATURES, self.reg, self.elastic_net)
        return models.cross_validate(prepared, search, self.label, keys, **options)

    def search_tree(self, prepared: DataFrame, keys: Sequence[str], **options) -> CrossValidatorModel:
        search = models.tree_search(
            self.label, TREE_FEATURES, self.depth, self.min_instances, maxBins=self.max_bins)
        return models.cross_validate(prepared, search, self.label, keys, **options)


def _study(schema: str, label: str, *grids, **options) -> Study:
    named = {key: options.pop(key) for key in ("numeric", "categorical") if key in options}
    numeric, categorical = feature_columns(column_names(schema), label, **named)
    return Study(label, numeric, categorical, *grids, **options)


# Which columns are numbers, and the grids of the two searches.
STROKE = _study(
    "stroke", "stroke", models.BINARY_REG, models.BINARY_DEPTH, models.BINARY_MIN_INSTANCES,
    numeric=("age", "avg_glucose_level", "bmi"))
FOREST_COVER = _study(
    "forest_cover", "Cover_Type", models.MULTI_REG, models.MULTI_DEPTH, models.MULTI_MIN_INSTANCES,
    categorical=("Wilderness_Area", "Soil_Type"), max_bins=models.MULTI_MAX_BINS)
