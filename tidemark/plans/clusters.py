"""Clusters of competitors, for several numbers of clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame

from tidemark.operators.clusterings import kmeans_sweep
from tidemark.operators.features import MOST_CATEGORIES, check_categories, feature_stages


def cluster_report(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), ks: Sequence[int] = range(2, 8),
    most_categories: int = MOST_CATEGORIES,
) -> DataFrame:
    """``k, sse, silhouette, cluster, size`` over the features of mixed columns."""
    check_categories(df, categorical, most_categories)
    stages = feature_stages(numeric, categorical, unseen="error")
    return kmeans_sweep(Pipeline(stages=stages).fit(df).transform(df), ks)
