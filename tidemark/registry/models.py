"""Models and their metrics.

Metrics are checked by SQL on predictions made by a rule; fitted models have no SQL, except the
regression whose solution is a formula.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.operators.caching import written
from tidemark.operators.features import hash_split
from tidemark.operators.clusterings import kmeans_sweep as sweep
from tidemark.operators.models import importance_rows
from tidemark.plans import conversions, forecasts
from tidemark.plans.clusters import cluster_report
from tidemark.plans.recommendations import (
    fit_recommender,
    new_recommendations,
    percent_ratings,
    score,
    top_items,
    with_history,
)
from tidemark.registry.relational import (
    EUROPEAN_NATIONS,
    REPORTED_NATIONS,
    chapter_views,
    free_trials,
)
from tidemark.registry.statistics import rounded
from tidemark.sources.files import read_table

CHURN_NUMERIC = ["firstSub", "age", "all_time_views", "last_month_views"]
CHURN_CATEGORICAL = ["payment_method_type", "country", "rebill_period_in_months"]


# Regression


def parts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")


def linreg_coefs(spark: SparkSession, folder: str) -> DataFrame:
    data = parts(spark, folder)
    model = forecasts.linear_fit(data, "p_retailprice", ["p_size", "p_partkey"])
    return rounded(forecasts.linear_weights(model, data), "weight", digits=6)


def linreg_scores(spark: SparkSession, folder: str) -> DataFrame:
    data = parts(spark, folder)
    model = forecasts.linear_fit(data, "p_retailprice", ["p_size", "p_partkey"])
    return rounded(model.transform(data).select("p_partkey", "prediction"), "prediction", digits=4)


def price_guess(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of order lines beside a guess from the quantity."""
    lines = read_table(spark, folder, "lineitem")
    return lines.select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )


def reg_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.regression_metrics(price_guess(spark, folder)), "r2", "rmse", digits=6)


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with the columns of the price model; ``line_key`` identifies a line."""
    lines = read_table(spark, folder, "lineitem")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"),
        F.col("l_extendedprice").alias("label"),
        "l_quantity",
        "l_discount",
        F.try_divide("l_tax", F.col("l_discount") + 1).alias("tax_share"),
        "l_returnflag",
        "l_linestatus",
    )


def searched_prices(spark: SparkSession, folder: str) -> forecasts.SearchedModel:
    return forecasts.searched_regression(
        priced_lines(spark, folder), "line_key", "label",
        ["l_quantity", "l_discount", "tax_share"], ["l_returnflag", "l_linestatus"],
    )


def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    return searched_prices(spark, folder).candidates()


def price_report(spark: SparkSession, folder: str) -> DataFrame:
    return forecasts.regression_report(searched_prices(spark, folder), "label")


def views_forecast(spark: SparkSession, folder: str) -> DataFrame:
    views = forecasts.with_views_label(forecasts.clean_chapter_views(chapter_views(spark, folder)))
    model = forecasts.searched_regression(
        views, "customer_id", "label", ["firstSub", "all_time_views", "last_month_views"],
        CHURN_CATEGORICAL, forecasts.VIEWS_GRID, train_tenths=9,
    )
    return model.weights()


# Classification


def searched_churn(spark: SparkSession, folder: str) -> forecasts.SearchedModel:
    views = forecasts.clean_chapter_views(chapter_views(spark, folder))
    labelled = forecasts.with_inactive_label(views)
    return forecasts.searched_churn(labelled, "customer_id", CHURN_NUMERIC, CHURN_CATEGORICAL)


def logreg(spark: SparkSession, folder: str) -> DataFrame:
    return forecasts.churn_report(searched_churn(spark, folder))[0]


def logreg_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return forecasts.churn_report(searched_churn(spark, folder))[1]


def return_guess(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a line was returned beside a guess from its quantity."""
    lines = read_table(spark, folder, "lineitem")
    return lines.select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_quantity") > 20).cast("double").alias("prediction"),
    )


def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.binary_rates(return_guess(spark, folder))


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_counts(return_guess(spark, folder))


def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.accuracy(return_guess(spark, folder)), "accuracy", digits=10)


def split_trials(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    trials = conversions.labelled_trials(
        free_trials(spark, folder), REPORTED_NATIONS, EUROPEAN_NATIONS
    )
    return hash_split(trials, "customer_id")


def tree_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out accuracy of the decision tree."""
    training, holdout = split_trials(spark, folder)
    model = conversions.fit_conversion(training, "tree")
    return metrics.accuracy(model.transform(holdout))


def tree_regressor(spark: SparkSession, folder: str) -> DataFrame:
    training, holdout = split_trials(spark, folder)
    model = conversions.fit_conversion(training, "tree_regression")
    return metrics.regression_metrics(model.transform(holdout))


def forest(spark: SparkSession, folder: str) -> DataFrame:
    training, holdout = split_trials(spark, folder)
    model = conversions.fit_conversion(training, "forest")
    return metrics.accuracy(model.transform(holdout))


def forest_importance(spark: SparkSession, folder: str) -> DataFrame:
    training, _ = split_trials(spark, folder)
    model = conversions.fit_conversion(training, "forest")
    return importance_rows(model.stages[-1], training, ["country_index", *conversions.USAGE])


# Clustering: the label of an embedding is its given cluster.


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = read_table(spark, folder, "embeddings")
    doubles = F.col("embedding").cast("array<double>")
    return embeddings.select("label", array_to_vector(doubles).alias("features"))


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.cluster_sizes(vectors(spark, folder), "label")


def cluster_sse(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.cluster_sse(vectors(spark, folder), "label"), "sse", digits=6)


def cluster_centers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.cluster_centers(vectors(spark, folder), "label"), "center")


def cluster_silhouette(spark: SparkSession, folder: str) -> DataFrame:
    score = metrics.silhouette(vectors(spark, folder), "label")
    return rounded(spark.createDataFrame([(score,)], "silhouette double"), "silhouette")


def kmeans_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return sweep(vectors(spark, folder))


def kmeans_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """The sweep over a category and numbers."""
    return cluster_report(read_table(spark, folder, "part"), ["p_size", "p_retailprice"], ["p_type"])


# Recommendation: customers rate parts by the quantity they order.


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    # the ratings of a customer lie together and in order: they are smaller then, and so is what is grouped by customer
    shares = (
        joined.repartition("o_custkey").groupBy("o_custkey", "l_partkey").agg((F.avg("l_quantity") / 50).alias("share"))
    )
    return percent_ratings(shares, "o_custkey", "l_partkey", "share").sortWithinPartitions("o_custkey", "l_partkey")


def split_ratings(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Ratings split by user and item together, from one reading of the orders."""
    rated = written(ratings(spark, folder), "als-ratings")
    keyed = rated.withColumn("pair", F.concat_ws("-", "o_custkey", "l_partkey"))
    training, holdout = hash_split(keyed, "pair", 9)
    return training.drop("pair"), holdout.drop("pair")


def als_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Error on held-out ratings, unknown users and items dropped."""
    training, holdout = split_ratings(spark, folder)
    model = fit_recommender(training, "o_custkey", "l_partkey", "share")
    return metrics.regression_metrics(score(model, holdout), label="share")


def fitted(spark: SparkSession, folder: str):
    """A model, and the ratings it was fitted to, which are written once for all that read them."""
    rated = written(ratings(spark, folder), "als-ratings")
    return fit_recommender(rated, "o_custkey", "l_partkey", "share"), rated


def urgent_users(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'")
    return orders.select("o_custkey")


def rated_parts(rated: DataFrame) -> DataFrame:
    """The parts that each customer has rated, ``known``: a list is shuffled at a fraction of its rows' size."""
    return rated.groupBy("o_custkey").agg(F.collect_set("l_partkey").alias("known"))


def als_topk(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = fitted(spark, folder)
    return top_items(model, urgent_users(spark, folder))


def als_new_items(spark: SparkSession, folder: str) -> DataFrame:
    model, rated = fitted(spark, folder)
    return new_recommendations(model, urgent_users(spark, folder), rated)


def als_new_counts(spark: SparkSession, folder: str) -> DataFrame:
    """New items per asked user: how many, their ranks, and how many of them the user has rated."""
    model, rated = fitted(spark, folder)
    new = new_recommendations(model, urgent_users(spark, folder), rated)
    return (
        new.join(rated_parts(rated), "o_custkey", "left")
        .groupBy("o_custkey")
        .agg(
            F.count_distinct("l_partkey").alias("items"),
            F.min("rank").alias("first_rank"),
            F.max("rank").alias("last_rank"),
            F.count_if(F.array_contains("known", F.col("l_partkey"))).alias("known"),
        )
    )


def als_history_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each kind beside the history per asked user, and how many new ones the user has rated."""
    model, rated = fitted(spark, folder)
    beside = with_history(model, urgent_users(spark, folder), rated)
    new = F.col("kind") == "new"
    # only new rows ask whether they are known, so the long history is not joined with itself
    known = F.array_contains("known", F.col("l_partkey"))
    looked_up = beside.where(new).join(rated_parts(rated), "o_custkey", "left").withColumn("known", known)
    return (
        looked_up.unionByName(beside.where(~new), allowMissingColumns=True)
        .groupBy("o_custkey")
        .agg(
            F.count_if(new).alias("new_items"),
            F.count_if(~new).alias("watched"),
            F.count_if(new & F.col("known")).alias("new_but_known"),
        )
    )


def als_with_history(spark: SparkSession, folder: str) -> DataFrame:
    model, rated = fitted(spark, folder)
    return with_history(model, urgent_users(spark, folder), rated)


QUERIES = {
    "linreg_coefs": linreg_coefs,
    "linreg_scores": linreg_scores,
    "reg_metrics": reg_metrics,
    "class_metrics": class_metrics,
    "confusion": confusion,
    "accuracy": accuracy,
    "cluster_sizes": cluster_sizes,
    "cluster_sse": cluster_sse,
    "cluster_centers": cluster_centers,
    "cluster_silhouette": cluster_silhouette,
    "grid_search": grid_search,
    "price_report": price_report,
    "views_forecast": views_forecast,
    "logreg": logreg,
    "logreg_confusion": logreg_confusion,
    "tree_classifier": tree_classifier,
    "tree_regressor": tree_regressor,
    "forest": forest,
    "forest_importance": forest_importance,
    "kmeans_sweep": kmeans_sweep,
    "kmeans_mixed": kmeans_mixed,
    "als_scores": als_scores,
    "als_topk": als_topk,
    "als_new_items": als_new_items,
    "als_new_counts": als_new_counts,
    "als_history_counts": als_history_counts,
    "als_with_history": als_with_history,
}

# Least squares with two features: normal equations from population covariances.
LEAST_SQUARES = """
    moments AS (
        SELECT covar_pop(p_size, p_size) AS a, covar_pop(p_size, p_partkey) AS b,
               covar_pop(p_partkey, p_partkey) AS c, covar_pop(p_size, p_retailprice) AS f,
               covar_pop(p_partkey, p_retailprice) AS g, avg(p_size) AS mx, avg(p_partkey) AS mz,
               avg(p_retailprice) AS my
        FROM part),
    slopes AS (SELECT *, (f * c - b * g) / (a * c - b * b) AS b1,
                      (a * g - b * f) / (a * c - b * b) AS b2 FROM moments),
    solved AS (SELECT *, my - b1 * mx - b2 * mz AS b0 FROM slopes)"""

GUESSES = """
    guesses AS (SELECT (l_returnflag = 'R')::INTEGER::DOUBLE AS label,
                       (l_quantity > 20)::INTEGER::DOUBLE AS prediction FROM lineitem),
    counts AS (SELECT count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE AS tp,
                      count(*) FILTER (label = 0 AND prediction = 1)::DOUBLE AS fp,
                      count(*) FILTER (label = 0 AND prediction = 0)::DOUBLE AS tn,
                      count(*) FILTER (label = 1 AND prediction = 0)::DOUBLE AS fn FROM guesses)"""

DIMENSIONS = """
    dims AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dimension,
                    unnest(embedding)::DOUBLE AS x
             FROM embeddings)"""

SQL = {
    "linreg_coefs": f"""
        WITH {LEAST_SQUARES}
        SELECT '(intercept)' AS feature, round(b0, 6) + 0.0 AS weight FROM solved
        UNION ALL SELECT 'p_size', round(b1, 6) + 0.0 FROM solved
        UNION ALL SELECT 'p_partkey', round(b2, 6) + 0.0 FROM solved""",
    "linreg_scores": f"""
        WITH {LEAST_SQUARES}
        SELECT p_partkey, round(b0 + b1 * p_size + b2 * p_partkey, 4) + 0.0 AS prediction
        FROM part, solved""",
    "reg_metrics": """
        WITH guesses AS (SELECT l_extendedprice AS label, l_quantity * 1500 AS prediction FROM lineitem)
        SELECT count(*) AS rows,
               round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) + 0.0 AS r2,
               round(sqrt(avg((label - prediction) ** 2)), 6) + 0.0 AS rmse
        FROM guesses""",
    "class_metrics": f"""
        WITH {GUESSES}
        SELECT tp / (tp + fn) AS true_positive_rate, tn / (tn + fp) AS true_negative_rate,
               fp / (fp + tn) AS false_positive_rate, fn / (fn + tp) AS false_negative_rate,
               tp / (tp + fp) AS "precision", (tp + tn) / (tp + tn + fp + fn) AS accuracy
        FROM counts""",
    "confusion": f"WITH {GUESSES} SELECT label, prediction, count(*) AS total FROM guesses GROUP BY ALL",
    "accuracy": f"""
        WITH {GUESSES}
        SELECT round(avg((label = prediction)::INTEGER::DOUBLE), 10) AS accuracy FROM guesses""",
    # Five, or as many parts as the user has not ordered yet.
    "als_new_counts": """
        WITH rated AS (SELECT DISTINCT o_custkey, l_partkey
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        urgent AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'),
        news AS (SELECT o_custkey,
                        least(5, (SELECT count(DISTINCT l_partkey) FROM rated) - count(*)) AS n
                 FROM rated JOIN urgent USING (o_custkey) GROUP BY o_custkey)
        SELECT o_custkey, n AS items, 1 AS first_rank, n::INTEGER AS last_rank,
               0::BIGINT AS known
        FROM news WHERE n > 0""",
    "als_history_counts": """
        WITH rated AS (SELECT DISTINCT o_custkey, l_partkey
                       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
        urgent AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
        SELECT o_custkey, least(5, (SELECT count(DISTINCT l_partkey) FROM rated) - count(*)) AS new_items,
               count(*) AS watched, 0::BIGINT AS new_but_known
        FROM rated JOIN urgent USING (o_custkey) GROUP BY o_custkey""",
    "cluster_sizes": "SELECT label, count(*) AS total FROM embeddings GROUP BY label",
    "cluster_sse": f"""
        WITH {DIMENSIONS}, spread AS (
            SELECT count(x) * var_pop(x) AS s FROM dims GROUP BY label, dimension)
        SELECT round(sum(s), 6) + 0.0 AS sse FROM spread""",
    "cluster_centers": f"""
        WITH {DIMENSIONS}
        SELECT label, dimension::INTEGER AS dimension, round(avg(x), 8) + 0.0 AS center
        FROM dims GROUP BY ALL""",
    "cluster_silhouette": f"""
        WITH {DIMENSIONS},
        squares AS (SELECT vec_id, label, sum(x * x) AS sq FROM dims GROUP BY ALL),
        clusters AS (SELECT label AS k, count(*) AS n, sum(sq) AS psi FROM squares GROUP BY ALL),
        sums AS (SELECT label AS k, dimension, sum(x) AS y FROM dims GROUP BY ALL),
        dots AS (SELECT vec_id, k, sum(x * y) AS dot FROM dims JOIN sums USING (dimension) GROUP BY ALL),
        away AS (
            SELECT vec_id, label, k, n, sq * n + psi - 2 * dot AS total
            FROM squares JOIN dots USING (vec_id) JOIN clusters USING (k)),
        ab AS (
            SELECT vec_id, max(total / (n - 1)) FILTER (k = label AND n > 1) AS a,
                   min(total / n) FILTER (k <> label) AS b
            FROM away GROUP BY vec_id)
        SELECT round(avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b
                              WHEN a > b THEN b / a - 1 ELSE 0 END), 8) + 0.0 AS silhouette
        FROM ab""",
}
