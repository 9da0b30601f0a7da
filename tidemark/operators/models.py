"""Fitted models: estimators with fixed seeds, parameter search, and models as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
# Hash buckets of ids; their sizes are summed in one task.
ID_BUCKETS = 4096
# Ratings whose factors are cheap to exchange; and for more, the fewest blocks and the ratings that one can hold.
FEW_RATINGS, LEAST_BLOCKS, BLOCK_RATINGS = 2_000_000, 4, 40_000_000
# Where the number of ids is known: the fewest blocks, and the ratings that one holds at most.
FEWEST_BLOCKS, MOST_BLOCK_RATINGS = 3, 80_000_000
# Ratings of a block while it is built, when it takes about 48 bytes a rating beside those of its neighbours.
MOST_HELD_RATINGS = 24_000_000
# Iterations on many ratings after which the exchanged factors of those before are removed.
CHECKPOINT_EVERY = 3
# A rating as a block keeps it, and the factors of an id.
RATING_BYTES, FACTOR_BYTES = 8, 40


def parameter_grid(estimator: Estimator, values: Mapping[str, Sequence[float]]) -> list:
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(choices))
    return builder.build()


@dataclass
class Search:
    """Result of a parameter search: the best candidate fitted on all rows, and every candidate's metric."""

    best: Model
    grid: list
    metrics: list[float]
    chosen: int


def validation_search(
    estimator: Estimator, grid: list, evaluator: Evaluator, data: DataFrame, validation: str,
    parallelism: int = 4,
) -> Search:
    """Fit the grid on the rows of ``data`` where ``validation`` is false and judge it on the others.

    The column is given by the caller, from a hash of the key, so the rows and with them the choice do
    not depend on how ``data`` is partitioned. ``parallelism`` candidates are fitted at a time; of
    equal metrics the first wins. ``data`` is read many times and should be kept.
    """
    fitted = estimator.fitMultiple(data.where(~F.col(validation)), grid)
    judged = data.where(validation)

    def judge(_: int) -> tuple[int, float]:
        position, model = next(fitted)
        return position, float(evaluator.evaluate(model.transform(judged)))

    with ThreadPoolExecutor(parallelism) as pool:
        metrics = [metric for _, metric in sorted(pool.map(judge, range(len(grid))))]
    best = max if evaluator.isLargerBetter() else min
    chosen = metrics.index(best(metrics))
    return Search(estimator.fit(data, grid[chosen]), grid, metrics, chosen)


def search_results(search: Search, data: DataFrame) -> DataFrame:
    """One row per candidate: its parameters, ``metric``, and whether it was ``chosen``."""
    rows = []
    for position, (params, metric) in enumerate(zip(search.grid, search.metrics)):
        named = {p.name: float(v) for p, v in params.items()}
        rows.append((*[named[k] for k in sorted(named)], metric, position == search.chosen))
    names = sorted(p.name for p in search.grid[0])
    schema = ", ".join([*[f"{n} double" for n in names], "metric double", "chosen boolean"])
    return data.sparkSession.createDataFrame(rows, schema)


def weight_rows(model: Model, data: DataFrame, names: Sequence[str]) -> DataFrame:
    """``feature, weight`` of a linear or logistic model, the intercept included."""
    rows = [("(intercept)", float(model.intercept))]
    rows += [(name, float(w)) for name, w in zip(names, model.coefficients)]
    return data.sparkSession.createDataFrame(rows, "feature string, weight double")


def importance_rows(model: Model, data: DataFrame, names: Sequence[str]) -> DataFrame:
    """``feature, importance`` of a tree or forest."""
    rows = [(name, float(w)) for name, w in zip(names, model.featureImportances.toArray())]
    return data.sparkSession.createDataFrame(rows, "feature string, importance double")


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the vector's entries, from the metadata the assembler left."""
    groups = df.schema[features].metadata["ml_attr"]["attrs"]
    entries = sorted((a for group in groups.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in entries]


def kmeans(k: int, features: str = "features", seed: int = SEED) -> KMeans:
    return KMeans(k=k, featuresCol=features, seed=seed)


def number_ids(df: DataFrame, column: str, name: str, buckets: int = ID_BUCKETS) -> DataFrame:
    """``column, name``: the distinct ids of any type and an int for each, from 0 without gaps.

    Ids are numbered within hash buckets, and buckets follow one another, so the numbers are the same on
    every run. ALS takes 2^31 ids at most, hence a bucket holds half a million. Null ids get no number.
    """
    ids = df.select(column).where(F.col(column).isNotNull()).distinct()
    bucketed = ids.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(column)) - 1
    placed = bucketed.withColumn("_place", place).join(starts, "_bucket")
    return placed.select(column, (F.col("_start") + F.col("_place")).cast("int").alias(name))


def als(user: str, item: str, rating: str, seed: int = SEED, blocks: int = 10, rows: int = 0) -> ALS:
    """Explicit-rating ALS; users and items unknown to the model are dropped when scoring.

    ``blocks`` is the number of tasks that users, and items, are divided among. Of ``rows`` ratings that are many, blocks
    and factors are kept on disk, since the heap is needed for those at work, and where there is a checkpoint folder
    the exchanges of earlier iterations are removed every ``CHECKPOINT_EVERY``.
    """
    fit = ALS(
        userCol=user, itemCol=item, ratingCol=rating, maxIter=10, regParam=0.1, seed=seed,
        coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks,
    )
    if rows > FEW_RATINGS:
        fit.setIntermediateStorageLevel("DISK_ONLY").setFinalStorageLevel("DISK_ONLY").setCheckpointInterval(CHECKPOINT_EVERY)
    return fit


def als_blocks(df: DataFrame, least: int = 10, most: int = 1000, rows: int = 0, ids: int = 0) -> int:
    """One block per core, but no more than keeps the exchange between all blocks reasonable.

    Every half step sends the factors of an id to nearly every block, so with ``rows`` ratings that are many there is
    a block for two cores only, which halves the exchange, or for ``BLOCK_RATINGS`` if those are more.
    With their number of ``ids`` (users and items) there are no more blocks than let an iteration send as many bytes of
    factors as the ratings have, or than ``MOST_BLOCK_RATINGS`` ask for.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows <= FEW_RATINGS:
        return max(least, min(most, cores))
    blocks = max(LEAST_BLOCKS, min(most, cores // 2))
    if not ids:
        return max(blocks, -(-rows // BLOCK_RATINGS))
    cheap = rows * RATING_BYTES // (ids * FACTOR_BYTES)
    return max(FEWEST_BLOCKS, min(blocks, cheap), -(-rows // MOST_BLOCK_RATINGS))


def blocks_that_fit(blocks: int, rows: int) -> int:
    """``blocks``, or more where one of them would hold over ``MOST_HELD_RATINGS``."""
    return max(blocks, -(-rows // MOST_HELD_RATINGS))


def recommendation_rows(recommended: DataFrame, user: str, item: str) -> DataFrame:
    """``user, rank, item, rating`` from the array column of a recommendation."""
    flat = recommended.select(user, F.posexplode("recommendations").alias("_pos", "_rec"))
    return flat.select(
        user,
        (F.col("_pos") + 1).alias("rank"),
        F.col(f"_rec.{item}").alias(item),
        F.col("_rec.rating").alias("rating"),
    )


def recommend(model: ALSModel, users: DataFrame | None, k: int = 5) -> DataFrame:
    """Top ``k`` items for ``users``, or for every known user if None."""
    user, item = model.getUserCol(), model.getItemCol()
    if users is None:
        found = model.recommendForAllUsers(k)
    else:
        found = model.recommendForUserSubset(users.select(user).distinct(), k)
    return recommendation_rows(found, user, item)
