"""Quality of predictions and clusterings as plain aggregates: one pass, a few rows out."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", *by: str
) -> DataFrame:
    """``rows, r2, rmse`` of the predictions, for all rows or for each value of ``by``."""
    y, error = F.col(label), F.col(label) - F.col(prediction)
    known = df.where(y.isNotNull() & F.col(prediction).isNotNull())
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("variance"),
    ).select(
        *by,
        "rows",
        (1 - F.try_divide("mse", "variance")).alias("r2"),
        F.sqrt("mse").alias("rmse"),
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("total"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def binary_rates(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rates of a 0/1 classifier, with 1 as the positive class.

    ``true_positive_rate`` is over the actual positives, ``false_positive_rate`` over the actual
    negatives and so on; ``precision`` is over the predicted positives. A rate over nothing is null.
    """
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(actual & guess).alias("tp"),
        F.count_if(~actual & guess).alias("fp"),
        F.count_if(~actual & ~guess).alias("tn"),
        F.count_if(actual & ~guess).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.select(
        F.try_divide(tp, tp + fn).alias("true_positive_rate"),
        F.try_divide(tn, tn + fp).alias("true_negative_rate"),
        F.try_divide(fp, fp + tn).alias("false_positive_rate"),
        F.try_divide(fn, fn + tp).alias("false_negative_rate"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def cluster_sizes(df: DataFrame, cluster: str = "prediction") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("total"))


def cluster_moments(df: DataFrame, cluster: str = "prediction", features: str = "features") -> DataFrame:
    """``cluster, total, center, spread``: mean vector and summed squared distance from it.

    Vectors are summarised whole, so rows are not multiplied by their dimensions.
    """
    summary = Summarizer.metrics("count", "mean", "variance").summary(F.col(features))
    per_cluster = df.groupBy(cluster).agg(summary.alias("s"))
    variance = F.aggregate(vector_to_array("s.variance"), F.lit(0.0), lambda acc, v: acc + v)
    return per_cluster.select(
        cluster,
        F.col("s.count").alias("total"),
        vector_to_array("s.mean").alias("center"),
        (variance * (F.col("s.count") - 1)).alias("spread"),
    )


def cluster_centers(df: DataFrame, cluster: str = "prediction", features: str = "features") -> DataFrame:
    """Mean of every cluster and dimension: ``cluster, dimension, center``."""
    moments = cluster_moments(df, cluster, features)
    return moments.select(cluster, F.posexplode("center").alias("dimension", "center"))


def cluster_sse(df: DataFrame, cluster: str = "prediction", features: str = "features") -> DataFrame:
    """Sum of squared distances of all rows from the mean of their cluster."""
    return cluster_moments(df, cluster, features).agg(F.sum("spread").alias("sse"))


def silhouette(df: DataFrame, cluster: str = "prediction", features: str = "features") -> float:
    """Mean silhouette with squared Euclidean distance.

    It needs one vector of sums per cluster, never pairs of rows.
    """
    return ClusteringEvaluator(
        predictionCol=cluster, featuresCol=features, distanceMeasure="squaredEuclidean"
    ).evaluate(df)
