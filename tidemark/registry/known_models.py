"""Fitted models on targets that their features determine, so that SQL knows what they must find."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.operators.features import hash_split
from tidemark.operators.clusterings import kmeans_sweep
from tidemark.operators.models import importance_rows
from tidemark.plans import conversions, forecasts
from tidemark.plans.recommendations import Recommender, fit_recommender, percent_ratings, score, top_items
from tidemark.registry.statistics import rounded
from tidemark.sources.files import read_table

RIDGES = {"regParam": (0.01, 0.5, 0.1), "elasticNetParam": (0.0,)}
CHURN_GRID = {"regParam": (0.01, 0.1), "elasticNetParam": (0.0, 0.5)}


def keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return lines.withColumn("line_key", F.concat_ws("-", "l_orderkey", "l_linenumber"))


# Ridge regression: a linear target with some noise. Two features have a closed solution.


def searched_ridge(spark: SparkSession, folder: str) -> forecasts.SearchedModel:
    label = F.col("l_quantity") / 10 + F.col("l_discount") * 20 + F.col("l_linenumber") / 10
    lines = keyed_lines(spark, folder).withColumn("label", label)
    return forecasts.searched_regression(lines, "line_key", "label", ["l_quantity", "l_discount"], grid=RIDGES)


def ridge_search(spark: SparkSession, folder: str) -> DataFrame:
    """R² of every candidate on the validation rows, and the choice."""
    return rounded(searched_ridge(spark, folder).candidates(), "metric", digits=7)


def ridge_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of the chosen candidate, fitted on all training rows."""
    return rounded(searched_ridge(spark, folder).weights(), "weight", digits=7)


def ridge_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(forecasts.regression_report(searched_ridge(spark, folder), "label"), "r2", "rmse", digits=7)


# Classification: the label is a threshold of one column, so held-out rows must be predicted rightly.


def logreg_known(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion counts of lines of more than half the largest quantity."""
    label = (F.col("l_quantity") > 25).cast("double")
    lines = keyed_lines(spark, folder).withColumn("label", label)
    model = forecasts.searched_churn(lines, "line_key", ["l_quantity", "l_discount"], grid=CHURN_GRID)
    return forecasts.churn_report(model)[1]


def known_trials(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as trials that convert from six chapters on."""
    chapters = F.round(F.col("l_discount") * 100).cast("int")
    trials = keyed_lines(spark, folder).select(
        "line_key",
        F.col("l_returnflag").alias("country"),
        F.col("l_linenumber").alias("rebill_period"),
        chapters.alias("chapter_access_count"),
        F.col("l_quantity").alias("seconds_watched"),
        F.when(chapters >= 6, chapters).alias("payments_made"),
    )
    return hash_split(conversions.labelled_trials(trials, ("A", "N"), ("R",)), "line_key")


def held_out(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    training, holdout = known_trials(spark, folder)
    found = conversions.fit_conversion(training, kind).transform(holdout)
    return found.select("line_key", F.col("label").cast("double"), "prediction")


def tree_known(spark: SparkSession, folder: str) -> DataFrame:
    return held_out(spark, folder, "tree")


def tree_regressor_known(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(held_out(spark, folder, "tree_regression"), "prediction")


def forest_known(spark: SparkSession, folder: str) -> DataFrame:
    return held_out(spark, folder, "forest")


def tree_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of the tree's rules."""
    training, _ = known_trials(spark, folder)
    text = conversions.rules_text(conversions.fit_conversion(training, "tree"))
    rules = [(n, line.strip()) for n, line in enumerate(text.splitlines()) if n and line.strip()]
    return spark.createDataFrame(rules, "line int, rule string")


def tree_importance(spark: SparkSession, folder: str) -> DataFrame:
    training, _ = known_trials(spark, folder)
    model = conversions.fit_conversion(training, "tree")
    return importance_rows(model.stages[-1], training, ["country_index", *conversions.USAGE])


# Clustering: customers, whose regions are far from one another.


def kmeans_known(spark: SparkSession, folder: str) -> DataFrame:
    """``k, sse, silhouette, size`` for as many clusters as there are regions."""
    nations = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    customers = read_table(spark, folder, "customer").select("c_nationkey", "c_acctbal")
    placed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("n_regionkey") * 100.0).alias("region"), (F.col("c_acctbal") / 1000).alias("balance")
    )
    points = VectorAssembler(inputCols=["region", "balance"], outputCol="features").transform(placed)
    regions = read_table(spark, folder, "region").count()
    return rounded(kmeans_sweep(points, [regions]).drop("cluster"), "sse", "silhouette", digits=6)


def kmeans_known_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """``k, share, size`` for two to seven clusters of seven groups, each four times as far out as the one before.

    The best clusters are the k - 1 outermost groups and all others together. ``share`` is what they leave of the
    squared distances from the mean.
    """
    customers = read_table(spark, folder, "customer")
    group = F.col("c_custkey") % 7
    placed = customers.select((F.pow(F.lit(4.0), group) * 100).alias("x"), (F.col("c_acctbal") / 1000).alias("y"))
    points = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(placed)
    total = placed.agg((F.var_pop("x") + F.var_pop("y")) * F.count("*")).first()[0]
    return kmeans_sweep(points).select("k", F.round(F.col("sse") / F.lit(total), 9).alias("share"), "size")


# Recommendation: a rating is the product of a number of the user and one of the item.


def product_ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    pairs = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey")
    share = (F.col("o_custkey") % 4 + 1) * (F.col("l_partkey") % 5 + 1) / 20
    return percent_ratings(pairs.distinct().withColumn("share", share), "o_custkey", "l_partkey", "share")


def fitted(ratings: DataFrame) -> Recommender:
    return fit_recommender(ratings, "o_custkey", "l_partkey", "share", blocks=10)


def als_known_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out pairs of known users and items, and whether the prediction is ``near``."""
    keyed = product_ratings(spark, folder).withColumn("pair", F.concat_ws("-", "o_custkey", "l_partkey"))
    training, holdout = hash_split(keyed, "pair", 9)
    near = F.abs(F.col("prediction") - F.col("share")) < 20
    return score(fitted(training), holdout).select("o_custkey", "l_partkey", near.alias("near"))


def als_known_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Items per urgent user: how many, their ranks, and how many are of the best kind."""
    urgent = read_table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey")
    found = top_items(fitted(product_ratings(spark, folder)), urgent)
    return found.groupBy("o_custkey").agg(
        F.count_distinct("l_partkey").alias("items"),
        F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"),
        F.count_if(F.col("l_partkey") % 5 == 4).alias("best"),
    )


QUERIES = {
    "ridge_search": ridge_search,
    "ridge_weights": ridge_weights,
    "ridge_report": ridge_report,
    "logreg_known": logreg_known,
    "tree_known": tree_known,
    "tree_regressor_known": tree_regressor_known,
    "forest_known": forest_known,
    "tree_rules": tree_rules,
    "tree_importance": tree_importance,
    "kmeans_known": kmeans_known,
    "kmeans_known_sweep": kmeans_known_sweep,
    "als_known_scores": als_known_scores,
    "als_known_topk": als_known_topk,
}


def tenth(key: str, start: int = 1) -> str:
    return f"('0x' || substr(md5({key}), {start}, 8))::BIGINT % 10"


LINE_KEY = "l_orderkey || '-' || l_linenumber"

# Ridge in units of the standard deviations, those of the label included; twice, on the rows that the
# search fits and on all training rows.
RIDGE = f"""
    lines AS (
        SELECT l_quantity AS x1, l_discount AS x2, l_quantity / 10 + l_discount * 20 + l_linenumber / 10 AS y,
               {tenth(LINE_KEY)} < 8 AS training, {tenth(LINE_KEY, 9)} < 8 AS fitting
        FROM lineitem),
    uses AS (SELECT *, 'search' AS fit FROM lines WHERE training AND fitting
             UNION ALL SELECT *, 'final' FROM lines WHERE training),
    moments AS (
        SELECT fit, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2,
               stddev_pop(y) AS sy, corr(x1, x2) AS r12, corr(x1, y) AS r1, corr(x2, y) AS r2
        FROM uses GROUP BY fit),
    grid AS (SELECT unnest([0.01, 0.5, 0.1])::DOUBLE AS reg, unnest([1, 2, 3]) AS place),
    scaled AS (SELECT *, 1 + reg / sy AS d FROM moments, grid),
    slopes AS (SELECT *, (d * r1 - r12 * r2) / (d * d - r12 * r12) * sy / s1 AS b1,
                      (d * r2 - r12 * r1) / (d * d - r12 * r12) * sy / s2 AS b2 FROM scaled),
    solved AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM slopes),
    judged AS (
        SELECT reg, place, 1 - avg((y - b0 - b1 * x1 - b2 * x2) ** 2) / var_pop(y) AS metric
        FROM lines, solved WHERE fit = 'search' AND training AND NOT fitting GROUP BY reg, place),
    choice AS (SELECT reg FROM judged ORDER BY metric DESC, place LIMIT 1),
    best AS (SELECT * FROM solved WHERE fit = 'final' AND reg = (SELECT reg FROM choice))"""

TRIALS = f"""
    trials AS (SELECT {LINE_KEY} AS line_key, round(l_discount * 100) AS chapters,
                      {tenth(LINE_KEY)} < 8 AS training FROM lineitem)"""

HELD_OUT = f"""
    WITH {TRIALS}
    SELECT line_key, (chapters >= 6)::INTEGER::DOUBLE AS label, (chapters >= 6)::INTEGER::DOUBLE AS prediction
    FROM trials WHERE NOT training"""

PAIRS = """
    pairs AS (SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SQL = {
    "ridge_search": f"""
        WITH {RIDGE}
        SELECT 0.0::DOUBLE AS "elasticNetParam", reg AS "regParam", round(metric, 7) + 0.0 AS metric,
               reg = (SELECT reg FROM choice) AS chosen
        FROM judged""",
    "ridge_weights": f"""
        WITH {RIDGE}
        SELECT '(intercept)' AS feature, round(b0, 7) + 0.0 AS weight FROM best
        UNION ALL SELECT 'l_quantity', round(b1, 7) + 0.0 FROM best
        UNION ALL SELECT 'l_discount', round(b2, 7) + 0.0 FROM best""",
    "ridge_report": f"""
        WITH {RIDGE}, errors AS (
            SELECT CASE WHEN training THEN 'training' ELSE 'holdout' END AS part, y,
                   (y - b0 - b1 * x1 - b2 * x2) ** 2 AS e
            FROM lines, best)
        SELECT part, count(*) AS rows, round(1 - avg(e) / var_pop(y), 7) + 0.0 AS r2,
               round(sqrt(avg(e)), 7) + 0.0 AS rmse
        FROM errors GROUP BY part""",
    "logreg_known": f"""
        SELECT (l_quantity > 25)::INTEGER::DOUBLE AS label, (l_quantity > 25)::INTEGER::DOUBLE AS prediction,
               count(*) AS total
        FROM lineitem WHERE {tenth(LINE_KEY)} >= 9 GROUP BY ALL""",
    "tree_known": HELD_OUT,
    "tree_regressor_known": HELD_OUT,
    "forest_known": HELD_OUT,
    # One question, half way between the classes.
    "tree_rules": f"""
        WITH {TRIALS}, cut AS (
            SELECT (max(chapters) FILTER (chapters < 6) + min(chapters) FILTER (chapters >= 6)) / 2 AS x
            FROM trials WHERE training)
        SELECT 1 AS line, 'If (feature 2 <= ' || x || ')' AS rule FROM cut
        UNION ALL SELECT 2, 'Predict: 0.0' FROM cut
        UNION ALL SELECT 3, 'Else (feature 2 > ' || x || ')' FROM cut
        UNION ALL SELECT 4, 'Predict: 1.0' FROM cut""",
    "tree_importance": f"""
        WITH {TRIALS}
        SELECT unnest(['country_index', 'rebill_period', 'chapter_access_count', 'seconds_watched']) AS feature,
               unnest([0.0, 0.0, (count(DISTINCT chapters >= 6) > 1)::INTEGER, 0.0])::DOUBLE AS importance
        FROM trials WHERE training""",
    # Means of squared distances from sums of points, their squares and their numbers.
    "kmeans_known": """
        WITH points AS (
            SELECT row_number() OVER () AS id, n_regionkey AS own, n_regionkey * 100.0::DOUBLE AS x,
                   c_acctbal / 1000 AS y
            FROM customer JOIN nation ON c_nationkey = n_nationkey),
        clusters AS (
            SELECT own AS k, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x + y * y) AS sq,
                   count(*) * (var_pop(x) + var_pop(y)) AS spread
            FROM points GROUP BY own),
        away AS (SELECT id, own, k, n, (x * x + y * y) * n + sq - 2 * (x * sx + y * sy) AS total
                 FROM points, clusters),
        ab AS (SELECT id, max(total / (n - 1)) FILTER (k = own AND n > 1) AS a,
                      min(total / n) FILTER (k <> own) AS b
               FROM away GROUP BY id),
        score AS (SELECT avg(CASE WHEN a IS NULL THEN 0 WHEN a < b THEN 1 - a / b
                                  WHEN a > b THEN b / a - 1 ELSE 0 END) AS s FROM ab)
        SELECT (SELECT count(*)::INTEGER FROM region) AS k,
               (SELECT round(sum(spread), 6) + 0.0 FROM clusters) AS sse,
               (SELECT round(s, 6) + 0.0 FROM score) AS silhouette, n AS size
        FROM clusters""",
    "kmeans_known_sweep": """
        WITH points AS (SELECT c_custkey % 7 AS g, 4.0::DOUBLE ** (c_custkey % 7) * 100 AS x, c_acctbal / 1000 AS y
                        FROM customer),
        total AS (SELECT (var_pop(x) + var_pop(y)) * count(*) AS t FROM points),
        clusters AS (SELECT k, greatest(g, 7 - k) AS c, count(*) AS size,
                            count(*) * (var_pop(x) + var_pop(y)) AS sse
                     FROM points, range(2, 8) AS ks(k) GROUP BY ALL)
        SELECT k::INTEGER AS k, round(sum(sse) OVER (PARTITION BY k) / t, 9) + 0.0 AS share, size
        FROM clusters, total""",
    "als_known_scores": f"""
        WITH {PAIRS},
        parts AS (SELECT *, {tenth("o_custkey || '-' || l_partkey")} < 9 AS training FROM pairs)
        SELECT o_custkey, l_partkey, true AS near FROM parts
        WHERE NOT training AND o_custkey IN (SELECT o_custkey FROM parts WHERE training)
              AND l_partkey IN (SELECT l_partkey FROM parts WHERE training)""",
    "als_known_topk": f"""
        WITH {PAIRS}
        SELECT o_custkey, 5::BIGINT AS items, 1 AS first_rank, 5 AS last_rank, 5::BIGINT AS best
        FROM (SELECT DISTINCT o_custkey FROM pairs
              WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))""",
}
