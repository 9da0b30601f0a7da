"""Regression jobs, and the churn job on chapter views."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator, RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import inactive_label, zero_if_null
from tidemark.operators.caching import reused, spread
from tidemark.operators.features import MOST_CATEGORIES, check_categories, feature_stages, in_first_part
from tidemark.operators.metrics import binary_rates, confusion_counts, regression_metrics
from tidemark.operators.models import (
    Search,
    feature_names,
    parameter_grid,
    search_results,
    validation_search,
    weight_rows,
)
from tidemark.operators.moments import MOST_FEATURES, search_by_moments
from tidemark.operators.statistics import correlation_steps

# The parameter grids of the searches.
HOUSE_GRID = {"regParam": (0.01, 0.5, 0.1), "elasticNetParam": (0.0, 0.5, 1.0)}
VIEWS_GRID = {"regParam": (0.01, 0.1, 0.3, 0.5, 0.7, 1.0), "elasticNetParam": (0.0, 0.5, 1.0)}

VALIDATION = "_validation"


def linear_fit(
    df: DataFrame, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
    unseen: str = "error", most_categories: int = MOST_CATEGORIES,
) -> PipelineModel:
    """Pipeline of feature stages and a linear regression without regularisation."""
    check_categories(df, categorical, most_categories)
    regression = LinearRegression(labelCol=label)
    return Pipeline(stages=[*feature_stages(numeric, categorical, unseen), regression]).fit(df)


def linear_weights(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Intercept and coefficients of the pipeline's last stage: ``feature, weight``."""
    return weight_rows(model.stages[-1], df, feature_names(model.transform(df)))


def screen_features(
    df: DataFrame, target: str, dropped: Sequence[str], dropped_later: Sequence[str]
) -> DataFrame:
    """``step, col_a, col_b, corr``: of all columns with ``target`` in step 1, of all pairs among those
    that remain in step 2, in one pass."""
    candidates = [c for c in df.columns if c not in dropped]
    remaining = [c for c in candidates if c not in dropped_later]
    return correlation_steps(df, [[(c, target) for c in candidates], list(product(remaining, remaining))])


@dataclass
class SearchedModel:
    """A pipeline that ends in the best model of a search, with the data it was fitted and judged on.

    ``data`` has a column ``part`` with the values ``training`` and ``holdout``.
    """

    pipeline: PipelineModel
    search: Search
    data: DataFrame

    @property
    def training(self) -> DataFrame:
        return self.data.where("part = 'training'")

    @property
    def holdout(self) -> DataFrame:
        return self.data.where("part = 'holdout'")

    @property
    def best(self):
        return self.search.best

    def candidates(self) -> DataFrame:
        return search_results(self.search, self.training)

    def weights(self) -> DataFrame:
        return weight_rows(self.best, self.training, feature_names(self.pipeline.transform(self.training)))


def _searched(
    df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str],
    estimator: Estimator, grid: Mapping[str, Sequence[float]], evaluator: Evaluator, train_tenths: int,
    most_categories: int,
) -> SearchedModel:
    """Fit the feature stages and then search ``grid`` on the training part of ``df``.

    Both splits, training from held-out rows and fitting from validation rows, hash ``key`` with other
    digits of its digest. The source is read once: the columns of the model are kept for all passes.
    """
    part = F.when(in_first_part(key, train_tenths), "training").otherwise("holdout")
    data = df.withColumn("part", part)
    validation = (~in_first_part(key, train_tenths, digits=1)).alias(VALIDATION)
    training = data.where("part = 'training'").select(label, *numeric, *categorical, validation)
    with reused(training) as rows:
        check_categories(rows, categorical, most_categories)
        features = Pipeline(stages=feature_stages(numeric, categorical)).fit(rows)
        vectors = features.transform(rows).select(label, "features", VALIDATION)
        candidates = parameter_grid(estimator, grid)
        if _by_moments(estimator, grid, vectors):
            search = search_by_moments(estimator, candidates, vectors, VALIDATION)
        else:
            with spread(vectors) as kept:
                search = validation_search(estimator, candidates, evaluator, kept, VALIDATION)
    return SearchedModel(PipelineModel([*features.stages, search.best]), search, data)


def _by_moments(estimator: Estimator, grid: Mapping[str, Sequence[float]], vectors: DataFrame) -> bool:
    """Whether sums of products, which one pass gives, are all that the search needs; very wide vectors have too many."""
    linear = isinstance(estimator, LinearRegression) and set(grid) <= {"regParam", "elasticNetParam"}
    return linear and len(feature_names(vectors)) <= MOST_FEATURES


def searched_regression(
    df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
    grid: Mapping[str, Sequence[float]] = HOUSE_GRID, train_tenths: int = 8,
    most_categories: int = MOST_CATEGORIES,
) -> SearchedModel:
    """Linear regression searched by R² on the training part; every stage is fitted on it only.

    All candidates come from one pass over the vectors (:mod:`tidemark.operators.moments`).
    """
    return _searched(
        df, key, label, numeric, categorical, LinearRegression(labelCol=label), grid,
        RegressionEvaluator(labelCol=label, metricName="r2"), train_tenths, most_categories,
    )


def regression_report(model: SearchedModel, label: str) -> DataFrame:
    """``part, rows, r2, rmse`` on the training and the held-out rows, in one pass."""
    return regression_metrics(model.pipeline.transform(model.data), label, "prediction", "part")


def clean_chapter_views(views: DataFrame) -> DataFrame:
    """Active subscriptions with missing counts as zero; the forecast target keeps its nulls."""
    counts = ("firstSub", "all_time_views", "last_month_views")
    active = views.filter("is_cancelled = false").drop("observation_date", "is_cancelled")
    return active.withColumns({c: zero_if_null(F.col(c)) for c in counts})


def with_views_label(views: DataFrame, target: str = "next_month_views") -> DataFrame:
    """The forecast label: next month's views, none for null."""
    return views.withColumn(target, zero_if_null(F.col(target))).withColumnRenamed(target, "label")


def with_inactive_label(views: DataFrame, target: str = "next_month_views") -> DataFrame:
    """The churn label: 0 if there are views next month, else 1."""
    return views.withColumn(target, inactive_label(F.col(target))).withColumnRenamed(target, "label")


def searched_churn(
    df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str] = (),
    grid: Mapping[str, Sequence[float]] = VIEWS_GRID, train_tenths: int = 9,
    most_categories: int = MOST_CATEGORIES,
) -> SearchedModel:
    """Logistic regression on ``label`` searched by area under the ROC curve."""
    return _searched(
        df, key, "label", numeric, categorical, LogisticRegression(), grid,
        BinaryClassificationEvaluator(), train_tenths, most_categories,
    )


def churn_report(model: SearchedModel) -> tuple[DataFrame, DataFrame]:
    """Rates and confusion counts on the held-out rows."""
    scored = model.pipeline.transform(model.holdout)
    return binary_rates(scored), confusion_counts(scored)
