"""Conversion of free trials: a decision tree and a random forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import (
    EUROPEAN_COUNTRIES,
    REPORTED_COUNTRIES,
    converted_label,
    country_group,
)
from tidemark.operators.caching import spread
from tidemark.operators.features import assembler, index_to_string, string_indexer
from tidemark.operators.models import SEED

TREE_DEPTH = 3
USAGE = ("rebill_period", "chapter_access_count", "seconds_watched")
ESTIMATORS = {
    "tree": DecisionTreeClassifier,
    "tree_regression": DecisionTreeRegressor,
    "forest": RandomForestClassifier,
}


def labelled_trials(
    trials: DataFrame,
    reported: Sequence[str] = REPORTED_COUNTRIES,
    europe: Sequence[str] = EUROPEAN_COUNTRIES,
) -> DataFrame:
    """``trials`` with grouped countries and a 0/1 ``label`` for at least one payment."""
    return trials.withColumns(
        {
            "country": country_group(F.col("country"), reported, europe),
            "label": converted_label(F.col("payments_made")),
        }
    )


def country_indexes(model: PipelineModel, trials: DataFrame) -> DataFrame:
    """The categories behind the index: ``country_index, value``."""
    indexer = model.stages[0]
    distinct = indexer.transform(trials).select("country_index").distinct()
    return index_to_string(indexer, "country_index", "value").transform(distinct)


def fit_conversion(training: DataFrame, kind: str = "tree", seed: int = SEED) -> PipelineModel:
    """Pipeline of country index, assembler and a ``tree``, ``tree_regression`` or ``forest``."""
    stages = [string_indexer(["country"]), assembler(["country_index", *USAGE])]
    features = Pipeline(stages=stages).fit(training)
    with spread(features.transform(training).select("label", "features")) as vectors:
        model = ESTIMATORS[kind](maxDepth=TREE_DEPTH, seed=seed).fit(vectors)
    return PipelineModel([*features.stages, model])


def rules_text(model: PipelineModel) -> str:
    """The fitted tree or trees as nested conditions."""
    return model.stages[-1].toDebugString
