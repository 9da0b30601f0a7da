"""Features, metrics and models: known values, and properties of fitted models."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import functions as F

from executed_plans import plan_of
from tidemark.operators import inner_products, metrics, models
from tidemark.operators.caching import reused, spread
from tidemark.operators.clusterings import kmeans_sweep
from tidemark.operators.features import (
    category_table,
    index_categories,
    check_categories,
    feature_stages,
    hash_split,
    index_to_string,
    one_hot_encoder,
    string_indexer,
)
from tidemark.operators.inner_products import top_inner_products
from tidemark.operators.moments import Moments, correlation_pairs, elastic_net, moments, search_by_moments
from tidemark.operators.ranks import with_rank
from tidemark.operators.models import als, als_blocks, feature_names, kmeans, number_ids, parameter_grid, recommend, validation_search
from tidemark.plans.forecasts import (
    churn_report,
    clean_chapter_views,
    regression_report,
    searched_churn,
    searched_regression,
    with_inactive_label,
    with_views_label,
)
from tidemark.plans import recommendations
from tidemark.plans.recommendations import (
    fit_recommender,
    new_recommendations,
    percent_ratings,
    score,
    top_items,
    with_history,
)
from tidemark.registry import models as registered
from tidemark.sources import schemas


@pytest.fixture
def colours(spark):
    data = [("red",), ("blue",), ("red",), ("green",), ("blue",), ("amber",)]
    return spark.createDataFrame(data, "colour string")


def test_index_order_and_back(spark, colours, rows):
    model = string_indexer(["colour"]).fit(colours)
    assert list(model.labelsArray[0]) == ["blue", "red", "amber", "green"]
    indexes = model.transform(colours).select("colour_index").distinct()
    named = index_to_string(model, "colour_index", "value").transform(indexes)
    assert rows(named) == [(0.0, "blue"), (1.0, "red"), (2.0, "amber"), (3.0, "green")]


def test_unseen_category_is_kept_or_raises(spark, colours):
    new = spark.createDataFrame([("violet",)], "colour string")
    assert string_indexer(["colour"]).fit(colours).transform(new).first().colour_index == 4.0
    with pytest.raises(Exception, match="(?i)unseen label"):
        string_indexer(["colour"], unseen="error").fit(colours).transform(new).collect()


def test_one_hot_drops_the_last_category(spark, colours):
    indexed = string_indexer(["colour"], unseen="error").fit(colours).transform(colours)
    encoded = one_hot_encoder(["colour_index"], unseen="error").fit(indexed).transform(indexed)
    arrays = encoded.select("colour", vector_to_array("colour_vector").alias("v")).distinct().collect()
    assert {r.colour: r.v for r in arrays} == {
        "blue": [1.0, 0.0, 0.0], "red": [0.0, 1.0, 0.0], "amber": [0.0, 0.0, 1.0], "green": [0.0] * 3
    }


def test_hash_split_is_whole_and_repeatable(spark, rows):
    df = spark.range(2000).withColumn("key", F.when(F.col("id") > 0, F.col("id")))
    first, second = hash_split(df, "key")
    assert first.count() + second.count() == 2000 and 1500 < first.count() < 1700
    shuffled, _ = hash_split(df.repartition(7), "key")
    assert rows(shuffled) == rows(first)
    assert second.where("key IS NULL").count() == 1


@pytest.fixture
def guesses(spark):
    data = [(1.0, 1.0)] * 5 + [(1.0, 0.0)] * 3 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 7
    return spark.createDataFrame(data, "label double, prediction double")


def test_binary_rates(guesses):
    found = metrics.binary_rates(guesses).first()
    assert found.true_positive_rate == 5 / 8 and found.false_negative_rate == 3 / 8
    assert found.true_negative_rate == 7 / 9 and found.false_positive_rate == 2 / 9
    assert found.precision == 5 / 7 and found.accuracy == 12 / 17
    evaluator = MulticlassClassificationEvaluator(metricName="precisionByLabel", metricLabel=1.0)
    assert math.isclose(found.precision, evaluator.evaluate(guesses))
    assert metrics.binary_rates(guesses.where("prediction = 0")).first().precision is None


def test_confusion_and_accuracy(guesses, rows):
    assert rows(metrics.confusion_counts(guesses)) == [
        (0.0, 0.0, 7), (0.0, 1.0, 2), (1.0, 0.0, 3), (1.0, 1.0, 5)
    ]
    assert math.isclose(metrics.accuracy(guesses).first()[0], 12 / 17)


def test_regression_metrics_equal_the_evaluator(spark):
    data = [(float(i), float(i) * 1.1 - 0.3 + (-1) ** i) for i in range(30)]
    df = spark.createDataFrame(data, "label double, prediction double")
    found = metrics.regression_metrics(df).first()
    for name in ("r2", "rmse"):
        assert math.isclose(found[name], RegressionEvaluator(metricName=name).evaluate(df))
    constant = df.withColumn("label", F.lit(1.0))
    assert metrics.regression_metrics(constant).first().r2 is None


@pytest.fixture
def points(spark):
    data = [[float(c * 10 + i % 3), float(c * 10 - i % 4)] for c in range(3) for i in range(20)]
    frame = spark.createDataFrame([(x,) for x in data], "x array<double>")
    return frame.select(array_to_vector("x").alias("features"))


def test_kmeans_is_repeatable_and_its_cost_is_the_sse(points, rows):
    model: KMeansModel = kmeans(3).fit(points)
    assigned = model.transform(points)
    assert math.isclose(metrics.cluster_sse(assigned).first().sse, model.summary.trainingCost, rel_tol=1e-9)
    assert rows(metrics.cluster_sizes(assigned)) == [(0, 20), (1, 20), (2, 20)]
    assert rows(kmeans(3).fit(points).transform(points)) == rows(assigned)
    assert 0.9 < metrics.silhouette(assigned) <= 1
    centers = metrics.cluster_centers(assigned).collect()
    found = sorted((r.prediction, r.dimension, round(r.center, 9)) for r in centers)
    wanted = sorted(
        (k, d, round(float(v), 9)) for k, c in enumerate(model.clusterCenters()) for d, v in enumerate(c)
    )
    assert found == wanted


@pytest.fixture
def houses(spark):
    noise = F.pmod(F.hash("id"), F.lit(100)) / 10
    grade = F.when(F.col("id") % 3 == 0, "low").when(F.col("id") % 3 == 1, "mid").otherwise("high")
    lift = F.when(grade == "high", 50).otherwise(0)
    size = (F.col("id") % 17).cast("double")
    price = size * 7 + lift + noise
    return spark.range(600).select("id", size.alias("size"), grade.alias("grade"), price.alias("price"))


def test_searched_regression(houses):
    grid = {"regParam": (0.01, 50.0), "elasticNetParam": (0.0, 1.0)}
    model = searched_regression(houses, "id", "price", ["size"], ["grade"], grid)
    candidates = model.candidates().collect()
    assert len(candidates) == 4 and sum(c.chosen for c in candidates) == 1
    chosen = next(c for c in candidates if c.chosen)
    assert chosen.metric == max(c.metric for c in candidates) and chosen.regParam == 0.01
    assert model.best.getRegParam() == 0.01
    report = {r.part: r for r in regression_report(model, "price").collect()}
    assert report["training"].rows + report["holdout"].rows == 600
    vectors = model.pipeline.transform(model.training).drop("prediction")
    assert math.isclose(report["training"].r2, model.best.evaluate(vectors).r2, abs_tol=1e-9)
    assert min(r.r2 for r in report.values()) > 0.9
    names = [r.feature for r in model.weights().collect()]
    assert names[:2] == ["(intercept)", "size"] and any("grade" in n for n in names)
    assert len(model.pipeline.stages) == 4


def test_the_search_does_not_depend_on_partitions(houses):
    grid = {"regParam": (0.01, 50.0), "elasticNetParam": (0.0, 1.0)}
    first = searched_regression(houses.coalesce(1), "id", "price", ["size"], ["grade"], grid).search
    other = searched_regression(houses.repartition(17), "id", "price", ["size"], ["grade"], grid).search
    assert first.chosen == other.chosen
    assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(first.metrics, other.metrics, strict=True))


def test_equal_metrics_choose_the_first_and_large_ones_only_where_better(spark):
    line = spark.range(40).select(
        F.col("id").cast("double").alias("label"),
        array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
        (F.col("id") % 4 == 0).alias("judge"),
    )
    regression = LinearRegression()
    grid = parameter_grid(regression, {"regParam": (9.0, 0.0, 0.0)})
    for metric in ("rmse", "r2"):
        found = validation_search(regression, grid, RegressionEvaluator(metricName=metric), line, "judge")
        assert found.chosen == 1 and len(found.metrics) == 3
        assert math.isclose(found.best.coefficients[0], 1.0, rel_tol=1e-6)


def test_indexes_are_fitted_on_training_rows_only(houses):
    rare = houses.withColumn("grade", F.when(F.col("id") == 1, "unique").otherwise(F.col("grade")))
    training, holdout = hash_split(rare, "id")
    key_in_holdout = holdout.select("id").first()[0]
    rare = houses.withColumn("grade", F.when(F.col("id") == key_in_holdout, "unique").otherwise(F.col("grade")))
    model = searched_regression(rare, "id", "price", ["size"], ["grade"], {"regParam": (0.1,)})
    assert "unique" not in model.pipeline.stages[0].labelsArray[0]
    assert regression_report(model, "price").count() == 2


def test_grid_has_every_combination():
    assert len(parameter_grid(LinearRegression(), {"regParam": (1, 2, 3), "elasticNetParam": (0, 1)})) == 6


@pytest.fixture
def views(spark):
    data = [
        (("card", "cash")[i % 2], ("US", "GB", "IN")[i % 3], (1, 12)[i % 2], i % 2 or None, 20 + i % 9,
         i % 11 or None, i % 5 or None, (None, 0, 3, 4)[i % 4], i % 10 == 0, None)
        for i in range(400)
    ]
    frame = spark.createDataFrame(data, schemas.CHAPTER_VIEWS)
    return frame.withColumn("id", F.monotonically_increasing_id())


def test_views_are_cleaned(views):
    clean = clean_chapter_views(views)
    assert clean.count() == 360
    assert not {"is_cancelled", "observation_date"} & set(clean.columns)
    assert clean.where("firstSub IS NULL OR all_time_views IS NULL OR last_month_views IS NULL").count() == 0
    assert clean.where("next_month_views IS NULL").count() > 0
    assert with_views_label(clean).where("label IS NULL").count() == 0
    inactive = with_inactive_label(clean)
    assert inactive.where("label = 1").count() == clean.where("coalesce(next_month_views, 0) = 0").count()


def test_searched_churn(views):
    labelled = with_inactive_label(clean_chapter_views(views))
    grid = {"regParam": (0.01, 1.0), "elasticNetParam": (0.0,)}
    model = searched_churn(labelled, "id", ["age", "all_time_views"], ["country", "payment_method_type"], grid)
    rates, counts = churn_report(model)
    assert sum(r.total for r in counts.collect()) == model.holdout.count()
    assert 0 <= rates.first().accuracy <= 1
    assert {r.chosen for r in model.candidates().collect()} == {True, False}


def test_feature_names_follow_the_vector(houses):
    from pyspark.ml import Pipeline

    vectors = Pipeline(stages=feature_stages(["size"], ["grade"], "error")).fit(houses).transform(houses)
    names = feature_names(vectors)
    assert names[0] == "size" and len(names) == len(vectors.first().features) == 3


@pytest.fixture
def watched(spark):
    data = [(u, c, ((u * 7 + c * 3) % 10) / 10) for u in range(30) for c in range(12) if (u + c) % 3]
    return spark.createDataFrame(data, "user bigint, course bigint, share double")


def test_recommendations(spark, watched, rows):
    rated = percent_ratings(watched, "user", "course", "share")
    assert rated.agg(F.max("share")).first()[0] <= 100
    model = fit_recommender(rated, "user", "course", "share")
    strangers = spark.createDataFrame([(1, 1), (1, 99), (777, 1)], "user bigint, course bigint")
    assert rows(score(model, strangers).select("user", "course")) == [(1, 1)]
    users = spark.createDataFrame([(1,), (2,), (2,), (777,)], "user bigint")
    found = top_items(model, users, 5)
    assert rows(found.groupBy("user").count()) == [(1, 5), (2, 5)]
    by_rank = [r.rating for r in found.where("user = 1").orderBy("rank").collect()]
    assert by_rank == sorted(by_rank, reverse=True)
    assert top_items(model, None, 3).count() == 30 * 3
    again = fit_recommender(rated, "user", "course", "share")
    assert rows(top_items(again, users, 5).select("user", "rank", "course")) == rows(
        found.select("user", "rank", "course")
    )
    new = new_recommendations(model, users, rated)
    assert new.join(rated, ["user", "course"]).count() == 0
    known = {u: rated.where(F.col("user") == u).count() for u in (1, 2)}
    assert known[1] > 5 or known[2] > 5
    assert rows(new.groupBy("user").agg(F.count("*"), F.max("rank"))) == [
        (u, min(5, 12 - known[u]), min(5, 12 - known[u])) for u in (1, 2)
    ]
    assert new_recommendations(model, users.limit(0), rated).count() == 0
    beside = with_history(model, users, rated)
    watched_rows = rated.where("user IN (1, 2)").count()
    new_rows = sum(min(5, 12 - known[u]) for u in (1, 2))
    assert rows(beside.groupBy("kind").count()) == [("new", new_rows), ("watched", watched_rows)]
    again = beside.where("kind = 'new'").join(beside.where("kind = 'watched'"), ["user", "course"])
    assert again.isEmpty()


@pytest.mark.parametrize("block_bytes", [32 << 20, 40 * 40, 1])
def test_top_products_against_all_pairs(spark, rows, monkeypatch, block_bytes):
    """With and without seen items, for items in one block and in many; users of few or no items left."""
    monkeypatch.setattr(inner_products, "STEP", 16)
    draw = np.random.default_rng(1)
    n = 150 if block_bytes > 1 else 7
    users, items = draw.normal(size=(20, 4)).astype("f4"), (draw.normal(size=(n, 4)) * draw.gamma(1, 2, (n, 1))).astype("f4")
    users[3] = 0
    items[5] = items[4]
    kinds = "id int, features array<float>"
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], kinds) for m in (users, items)]
    seen = [(u, int(i)) for u in range(0, 20, 2) for i in draw.choice(n, min(n, 9 * u), replace=False)]
    seen += [(0, 10**6), (4, seen[0][1])]
    for known in ([], seen):
        frame = spark.createDataFrame(known, "user int, item int") if known else None
        found = top_inner_products(*frames, 5, frame, block_bytes)
        got = {}
        for r in found.orderBy("user", "rank").collect():
            got.setdefault(r.user, []).append((r.item, r.rating))
        products = (users @ items.T).astype("f8")
        for u in range(20):
            left = [i for i in range(n) if (u, i) not in set(known)]
            want = sorted((-products[u, i], i) for i in left)[:5]
            assert np.allclose([p for _, p in got.get(u, [])], [-p for p, _ in want], atol=1e-4)
            assert all(i in left for i, _ in got.get(u, [])) and len({i for i, _ in got.get(u, [])}) == len(want)


def test_top_items_equal_those_of_spark(spark, watched, rows):
    rated = percent_ratings(watched, "user", "course", "share")
    model = fit_recommender(rated, "user", "course", "share")
    users = model.numbered(rated.select("user"))
    whole = recommend(model.model, users, 4)
    own = top_items(model, rated.select("user"), 4).join(model.users, "user").join(model.items, "course")
    want = {(r._user, r.rank): (r._item, round(r.rating, 2)) for r in whole.collect()}
    assert {(r._user, r.rank): (r._item, round(r.rating, 2)) for r in own.collect()} == want
    assert top_inner_products(model.model.userFactors, model.model.itemFactors.limit(0), 3).count() == 0


def test_ids_of_any_type(spark, watched, rows):
    """Ids beyond int and of text give the same recommendations; rows without an id teach nothing."""
    named = watched.select(
        (F.col("user") + 2**40).alias("user"), F.concat(F.lit("course "), "course").alias("course"), "share"
    )
    lost = spark.createDataFrame([(None, "course 1", 0.5), (2**40, None, 0.5)], named.schema)
    model = fit_recommender(named.unionByName(lost), "user", "course", "share")
    users = spark.createDataFrame([(2**40 + 1,), (5,), (None,)], "user bigint")
    found = top_items(model, users, 4)
    assert dict(found.dtypes) == {"user": "bigint", "rank": "int", "course": "string", "rating": "float"}
    assert [r[:2] for r in rows(found)] == [(2**40 + 1, rank) for rank in (1, 2, 3, 4)]
    assert {r.course for r in found.collect()} <= {f"course {c}" for c in range(12)}
    assert score(model, named).count() == named.count()


def test_numbers_of_ids_have_no_gaps(spark, rows):
    ids = spark.createDataFrame([(f"id {i % 40}",) for i in range(100)] + [(None,)], "id string")
    numbered = number_ids(ids, "id", "n", buckets=7)
    assert sorted(r.n for r in numbered.collect()) == list(range(40))
    assert rows(number_ids(ids.repartition(5), "id", "n", buckets=7)) == rows(numbered)
    assert number_ids(ids.limit(0), "id", "n").count() == 0


def test_als_settings():
    model = als("u", "i", "r")
    assert (model.getMaxIter(), model.getRegParam(), model.getColdStartStrategy()) == (10, 0.1, "drop")


def test_spread_frames_use_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    with spread(spark.range(100).coalesce(1), rows_per_task=10) as even:
        assert even.rdd.getNumPartitions() == cores and even.count() == 100
    assert not even.is_cached
    with spread(spark.range(100).coalesce(1)) as kept:
        assert kept.rdd.getNumPartitions() == 1
    many = spark.range(0, 100, 1, cores + 3)
    with spread(many) as kept:
        assert kept.rdd.getNumPartitions() == cores + 3


def test_spread_frames_have_few_tasks(spark):
    """Every task of every pass sends the driver a result, so tasks follow the cores, not the partitions."""
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 10 * cores)
    with spread(many) as kept:
        assert kept.rdd.getNumPartitions() == 2 * cores
        assert sorted(r.id for r in kept.collect()) == list(range(1000))
    with spread(many, most_rows=1000 // (4 * cores)) as kept:  # but no more rows in one than it can take
        assert 2 * cores < kept.rdd.getNumPartitions() <= 5 * cores and kept.count() == 1000


def test_blocks_of_many_ratings(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(1)
    assert als_blocks(df) == als_blocks(df, rows=1000) == max(10, cores)
    assert als_blocks(df, rows=3_000_000) == max(4, cores // 2)  # the exchange is with ids times blocks
    assert als_blocks(df, rows=2_000_000_000) == 50


def test_blocks_of_many_ids(spark):
    """Factors of few ratings each weigh more than the ratings, so fewer blocks exchange them, at any size."""
    df = spark.range(1)
    for rows in (3_600_000, 36_000_000, 216_000_000):
        assert als_blocks(df, rows=rows, ids=rows // 17) == 3
        assert als_blocks(df, rows=rows, ids=rows // 1000) == als_blocks(df, rows=3_000_000)
    assert als_blocks(df, rows=2_000_000_000, ids=10_000_000) == 25  # a block holds 80 million
    assert als_blocks(df, rows=1000, ids=1000) == als_blocks(df, rows=1000)


def test_fit_takes_blocks_by_ids(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(recommendations, "als_blocks", lambda df, **given: asked.append(given) or 2)
    rated = spark.createDataFrame([(u, 100 + i, float(u * i)) for u in range(6) for i in range(4)], "u int, i int, r double")
    fit_recommender(rated, "u", "i", "r")
    fit_recommender(rated, "u", "i", "r", blocks=1)
    assert asked == [{"rows": 24, "ids": 10}]


def test_blocks_hold_what_an_executor_can():
    """Exchanges ask for few blocks, but a block is built on the heap of one task."""
    assert models.blocks_that_fit(3, 216_000_000) == 9  # three a task of four, on three executors
    assert models.blocks_that_fit(3, 36_000_000) == 3
    assert models.blocks_that_fit(10, 600_000) == 10
    assert models.blocks_that_fit(25, 2_000_000_000) == 84


def test_many_ratings_leave_the_heap_to_the_fit():
    few, many = als("u", "i", "r", rows=2_000_000), als("u", "i", "r", rows=2_000_001)
    assert (few.getIntermediateStorageLevel(), few.getFinalStorageLevel()) == ("MEMORY_AND_DISK",) * 2
    assert (many.getIntermediateStorageLevel(), many.getFinalStorageLevel()) == ("DISK_ONLY",) * 2
    assert few.getCheckpointInterval() == 10 and many.getCheckpointInterval() == models.CHECKPOINT_EVERY


@pytest.mark.parametrize("user", ["int", "string"])
def test_fit_of_many_ratings_is_the_same(spark, monkeypatch, user):
    """Ratings are kept on disk, once if ids stand for themselves; factors are those of as many blocks with all in memory."""
    draw = np.random.default_rng(3)
    pairs = [(u, 100 + i, float(draw.integers(1, 50))) for u in range(40) for i in range(12) if (u + i) % 3]
    rated = spark.createDataFrame(pairs, "u int, i int, r double").select(F.col("u").cast(user).alias("u"), "i", "r")

    def factors(model):
        return {r.id: r.features for f in (model.model.userFactors, model.model.itemFactors) for r in f.collect()}

    asked, levels, kind = [], [], type(rated)
    persist = kind.persist
    monkeypatch.setattr(recommendations, "als", lambda *a, **given: asked.append(given) or als(*a, **given))
    few = factors(fit_recommender(rated, "u", "i", "r", blocks=4))
    monkeypatch.setattr(kind, "persist", lambda df, level: levels.append(level) or persist(df, level))
    monkeypatch.setattr(models, "FEW_RATINGS", 100)
    monkeypatch.setattr(models, "MOST_HELD_RATINGS", 80)
    monkeypatch.setattr(recommendations, "als_blocks", lambda df, **given: 2)
    many = factors(fit_recommender(rated, "u", "i", "r"))
    assert asked == [{"blocks": 4, "rows": 320}] * 2
    assert levels and all(x.useDisk and not x.useMemory for x in levels) and (user == "string" or len(levels) <= 2)
    assert few.keys() == many.keys() and all(np.allclose(few[k], many[k], atol=1e-4) for k in few)


def test_history_is_shuffled_as_lists(spark, rows, tmp_path):
    """Ratings of a customer lie together, so a task lists them before the shuffle, for those seen and those known."""
    folder = str(tmp_path)
    orders = [(o, o % 7 if o % 10 else None, "1-URGENT" if o % 3 else "5-LOW") for o in range(40)]
    lines = [(o, (o * n) % 9 if o % 11 else None, float(n)) for o in range(40) for n in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    rated = registered.ratings(spark, folder)
    plan = rated._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(o_custkey#\w+, \d", plan) and not re.search(r"hashpartitioning\([^)]*l_partkey", plan)
    homes = rated.withColumn("task", F.spark_partition_id()).groupBy("o_custkey").agg(F.count_distinct("task").alias("n"))
    assert {r.n for r in homes.collect()} == {1}
    known = {}
    for customer, part, _ in rows(rated):
        known.setdefault(customer, set()).add(part)
    known = {c: parts - {None} for c, parts in known.items()}
    listed = registered.rated_parts(rated)
    assert {r.o_custkey: set(r.known) for r in listed.collect()} == known
    partial = listed._jdf.queryExecution().executedPlan().toString()
    assert "partial_collect_set" in partial
    new = registered.als_new_items(spark, folder)
    assert "LeftSemi" not in new._jdf.queryExecution().optimizedPlan().toString().split("collect_set")[1]
    found = {}
    for r in new.collect():
        found.setdefault(r.o_custkey, set()).add(r.l_partkey)
    parts = set().union(*known.values())
    urgent = {c for _, c, p in orders if p == "1-URGENT" and known.get(c)} - {None}
    assert all(not (found.get(c, set()) & known[c]) for c in urgent)
    assert {c: len(p) for c, p in found.items()} == {c: n for c in urgent if (n := min(5, len(parts - known[c])))}
    counts = {r.o_custkey: (r.items, r["known"]) for r in registered.als_new_counts(spark, folder).collect()}
    assert counts == {c: (len(p), 0) for c, p in found.items()}


def test_users_who_are_done_leave_their_lists(spark, tmp_path, monkeypatch):
    """What is written after a block has factors and seen items only of those who go on to the next."""
    folders = []
    monkeypatch.setattr(inner_products, "shared_folder", lambda _, name: folders.append(f"{tmp_path}/{len(folders)}") or folders[-1])
    draw = np.random.default_rng(5)
    users, items = (draw.normal(size=(n, 4)).astype("f4") for n in (30, 90))
    items *= np.linspace(1, 9, 90, dtype="f4")[:, None]
    frames = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id int, features array<float>") for m in (users, items)]
    seen = spark.createDataFrame([(u, 89 - u) for u in range(30)] + [(77, 1)], "user int, item int")
    found = top_inner_products(*frames, 3, seen, block_bytes=32 * 30)
    products = users @ items.T
    products[np.arange(30), 89 - np.arange(30)] = -np.inf
    want = np.argsort(-products, axis=1)[:, :3]
    assert {(r["user"], r["rank"], r["item"]) for r in found.collect()} == {(u, k + 1, int(want[u, k])) for u in range(30) for k in range(3)}
    held = spark.read.parquet(*folders)
    assert held.where("open").count() and held.where("NOT open").count() == 30
    assert held.where("NOT open AND (features IS NOT NULL OR seen IS NOT NULL)").isEmpty()
    assert held.where("open AND (features IS NULL OR seen IS NULL)").isEmpty()


def test_ratings_are_made_once(spark, rows, tmp_path):
    folder = str(tmp_path)
    orders = [(o, o % 7, "1-URGENT") for o in range(40)]
    lines = [(o, (o * n) % 5, float(n)) for o in range(40) for n in (1, 2, 3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{folder}/lineitem.parquet")
    model, rated = registered.fitted(spark, folder)
    assert "Aggregate" not in rated._jdf.queryExecution().toString()
    assert rows(rated) == rows(registered.ratings(spark, folder))
    for part in registered.split_ratings(spark, folder):
        assert "Aggregate" not in part._jdf.queryExecution().toString()
    # ids that are their own numbers are not joined with a table of them
    assert model.ready == ("o_custkey", "l_partkey")
    assert "Join" not in model.with_numbers(rated)._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_unknown_ids_have_no_score(spark):
    rated = spark.createDataFrame([(u, i, float(u + i)) for u in range(4) for i in range(3)], "u long, i long, r double")
    model = fit_recommender(rated, "u", "i", "r")
    odd = [(0, 0, 1.0), (0, 7, 1.0), (9, 0, 1.0), (None, 1, 1.0), (1, None, 1.0), (-1, 1, 1.0), (1 << 32, 1, 1.0), (3, 2, None)]
    found = score(model, spark.createDataFrame(odd, "u long, i long, r double"))
    assert {(r["u"], r["i"], r["r"]) for r in found.collect()} == {(0, 0, 1.0), (3, 2, None)}
    seen = spark.createDataFrame([(0, 0), (0, 7), (9, 1), (0, None), (None, 1), (0, 1 << 32), (1, -1)], "u long, i long")
    new = new_recommendations(model, spark.createDataFrame([(0,), (1,), (9,)], "u long"), seen)
    assert {(r["u"], r["i"]) for r in new.collect()} == {(0, 1), (0, 2), (1, 0), (1, 1), (1, 2)}
    halves = spark.createDataFrame([(0.0, 1.5), (0.0, 1.0)], "u double, i double")
    assert [(r["u"], r["i"]) for r in score(model, halves).collect()] == [(0.0, 1.0)]


def test_few_products_are_ranked(spark, monkeypatch):
    """The k largest of a step are looked for where many can count only: at first."""
    draw = np.random.default_rng(3)
    users, items = (draw.normal(size=(n, 4)).astype(np.float32) for n in (50, 3000))
    items = items[np.argsort(-np.linalg.norm(items, axis=1))]
    monkeypatch.setattr(inner_products, "STEP", 300)
    calls, plain = [], np.partition
    monkeypatch.setattr(np, "partition", lambda *a, **b: calls.append(1) or plain(*a, **b))
    held = (np.zeros(0, dtype=int), np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.float32))
    numbered = (np.arange(3000, dtype=np.int32), items, np.linalg.norm(items, axis=1))
    none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    user, item, _ = inner_products._best(users, held, numbered, none, 5)
    assert len(calls) == 1
    products = users @ items.T
    assert item.reshape(50, 5).tolist() == np.argsort(-products, axis=1, kind="stable")[:, :5].tolist()

    def frame(rows):
        return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id int, features array<float>")

    found = inner_products.top_inner_products(frame(users).coalesce(1), frame(items), 5)
    assert found.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
    assert {(r["user"], r["item"]) for r in found.collect()} == set(zip(user.tolist(), item.tolist()))


def test_reused_frames_are_released(spark):
    df = spark.range(10)
    with pytest.raises(ValueError), reused(df) as kept:
        assert kept.is_cached
        raise ValueError
    assert not df.is_cached


def test_too_many_categories_raise(colours):
    check_categories(colours, ["colour"], most=5)
    check_categories(colours, [])
    with pytest.raises(ValueError, match="colour"):
        check_categories(colours, ["colour"], most=3)


def test_ranks_are_global(spark):
    rows = spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(100)).alias("a"), "id").repartition(7)
    ranked = with_rank(rows, F.desc("a"), F.asc("id"))
    found = [(r.a, r.id) for r in ranked.orderBy("rank").collect()]
    assert found == sorted(found, key=lambda r: (-r[0], r[1]))
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(5000))
    assert with_rank(rows.limit(0), F.asc("id")).count() == 0


def test_a_million_categories(spark):
    """Far more than the driver should hold: same numbers as the rule, values unseen and null get the next one."""
    n = 1_000_000
    values = spark.range(n + 1000).select(F.concat(F.lit("v"), F.pmod("id", F.lit(n))).alias("v"))
    table = category_table(values, "v", "i")
    assert table.agg(F.count("*"), F.count_distinct("i"), F.min("i"), F.max("i")).first()[:] == (n, n, 0.0, n - 1.0)
    often = sorted(f"v{k}" for k in range(1000))
    assert [r.v for r in table.where("i < 1000").orderBy("i").collect()] == often
    asked = spark.createDataFrame([(often[3],), ("none",), (None,)], "v string")
    assert [r.i for r in index_categories(asked, table, "v", "i").orderBy("i").collect()] == [3.0, float(n), float(n)]
    assert index_categories(asked, table, "v", "i", "skip").count() == 1


def test_search_by_moments_equals_fitting_every_candidate(spark, tmp_path):
    """Ridge, lasso and mixtures, with features that are collinear, constant, far from zero, or unknown in a row."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(900, 5)) * [1, 10, 0.1, 1, 1] + [0, 1e3, 3, 0, 2]
    x[:, 3] = x[:, 0] - x[:, 2]
    x[:, 4] = 2.0
    y = x[:, 0] * 3 + (x[:, 1] - 1e3) / 5 + x[:, 2] + draw.normal(size=900) + 1e2
    data = spark.createDataFrame([(row.tolist(), float(v), i % 5 == 0) for i, (row, v) in enumerate(zip(x, y))], "x array<double>, y double, judge boolean")
    data = data.select(array_to_vector("x").alias("features"), "y", "judge")
    regression = LinearRegression(labelCol="y")
    grid = parameter_grid(regression, {"regParam": (0.01, 0.5, 2.0), "elasticNetParam": (0.0, 0.5, 1.0)})
    found = search_by_moments(regression, grid, data.repartition(5), "judge")
    wanted = validation_search(regression, grid, RegressionEvaluator(labelCol="y", metricName="r2"), data, "judge")
    for params, a, b in zip(grid, found.metrics, wanted.metrics, strict=True):
        ridge = params[regression.elasticNetParam] == 0.0
        assert math.isclose(a, b, abs_tol=1e-8 if ridge else 1e-5), (params, a, b)  # the lasso of Spark stops early
    assert max(wanted.metrics) - wanted.metrics[found.chosen] < 1e-5
    fitted = regression.fit(data, grid[found.chosen])
    assert np.allclose(found.best.transform(data).toPandas()["prediction"], fitted.transform(data).toPandas()["prediction"], atol=0.05)
    found.best.write().overwrite().save(str(tmp_path / "model"))
    again = LinearRegressionModel.load(str(tmp_path / "model"))
    assert again.coefficients == found.best.coefficients and again.getLabelCol() == "y"
    plain = parameter_grid(regression, {"regParam": (0.3,)})
    ridge, wanted = search_by_moments(regression, plain, data, "judge").best, regression.fit(data, plain[0])
    assert np.allclose(ridge.coefficients, wanted.coefficients, atol=1e-7) and math.isclose(ridge.intercept, wanted.intercept, rel_tol=1e-7)
    lost = spark.createDataFrame([([float("nan")] * 5, 1.0, False), ([1.0] * 5, None, True)], "x array<double>, y double, judge boolean")
    more = data.unionByName(lost.select(array_to_vector("x").alias("features"), "y", "judge"))
    assert moments(more, "y", "features", "judge")[False].n == 720
    with pytest.raises(ValueError, match="no rows"):
        moments(data.limit(0), "y", "features", "judge")


def test_lasso_meets_its_conditions():
    """Optimality of every solution, also where features outnumber what the rows tell."""
    draw = np.random.default_rng(6)
    for n, d in ((50, 3), (40, 20), (15, 30)):
        x, w = draw.normal(size=(n, d)), draw.normal(size=d)
        whole = np.column_stack([x, x @ w + draw.normal(size=n)])
        found = Moments(n, whole.sum(axis=0), whole.T @ whole, np.zeros(d + 1))
        spread, sy = x.std(axis=0), whole[:, -1].std()
        for penalty, mixing in ((0.1, 1.0), (0.5, 0.5), (3.0, 1.0)):
            weights, intercept = elastic_net(found, penalty, mixing)
            error = whole[:, -1] - intercept - x @ weights
            slope = (error @ (x - x.mean(axis=0)) / n) / spread / sy - (1 - mixing) * penalty / sy * weights * spread / sy
            limit = mixing * penalty / sy
            assert np.all(np.abs(slope) <= limit + 1e-8)
            assert np.allclose(slope[weights != 0], limit * np.sign(weights[weights != 0]), atol=1e-8)
            assert math.isclose(found.r2(weights, intercept), 1 - error.var() / sy**2, abs_tol=1e-9)


def test_wide_correlations(spark):
    """Five hundred columns in one pass; pairs with nulls, and columns that do not vary."""
    width = 500
    columns = [(F.sin(F.col("id") * (k + 1)) + F.lit(1e5 * (k % 3))).alias(f"c{k}") for k in range(width)]
    data = spark.range(300).select(*columns, "id")
    data = data.withColumns(
        {"c1": F.when(F.col("id") % 7 != 0, F.col("c1")), "c2": F.lit(4), "c3": F.lit(None).cast("double"), "c4": F.when(F.col("id") == 0, 1)}
    )
    names = [f"c{k}" for k in range(width)]
    frame = correlation_pairs(data, names)
    found = {(r.col_a, r.col_b): r["corr"] for r in frame.collect()}
    assert len(found) == width * width
    wanted = data.toPandas()[names].astype("float64").corr()
    for a in (*names[:12], "c499"):
        for b in names:
            want = wanted.loc[a, b]
            if math.isnan(want):
                assert found[a, b] is None or a in ("c2", "c3", "c4") or b in ("c2", "c3", "c4")
            else:
                assert math.isclose(found[a, b], want, abs_tol=1e-8)
    assert found["c2", "c5"] is None and found["c3", "c5"] is None and found["c4", "c5"] is None
    plan = plan_of(frame)
    assert plan.count("Range (0, 300") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_sweep_of_all_clusterings_at_once(points, spark):
    """Errors and silhouettes are those of Spark for the same assignment, and no worse than its search."""
    found = {r.k: r for r in kmeans_sweep(points).collect()}
    assert sorted(found) == list(range(2, 8))
    for k in (2, 3):
        model = kmeans(k).fit(points)
        assert found[k].sse <= model.summary.trainingCost * (1 + 1e-9)
        if math.isclose(found[k].sse, model.summary.trainingCost, rel_tol=1e-9):
            assert math.isclose(found[k].silhouette, metrics.silhouette(model.transform(points)), abs_tol=1e-9)
    assert math.isclose(found[3].sse, kmeans(3).fit(points).summary.trainingCost, rel_tol=1e-9)
    sizes = [r["size"] for r in kmeans_sweep(points).where("k = 3").orderBy("cluster").collect()]
    assert sizes == [20, 20, 20]
    again = kmeans_sweep(points.repartition(3))
    assert [tuple(r)[:1] + tuple(r)[3:] for r in again.collect()] == [tuple(r)[:1] + tuple(r)[3:] for r in kmeans_sweep(points).collect()]
    same = spark.range(6).select(array_to_vector(F.array((F.col("id") % 2).cast("double"))).alias("features"))
    few = kmeans_sweep(same, [2, 4]).collect()
    assert [(r.k, r.sse, r["size"]) for r in few] == [(2, 0.0, 3), (2, 0.0, 3), (4, 0.0, 3), (4, 0.0, 3)]
    with pytest.raises(ValueError, match="no rows"):
        kmeans_sweep(same.limit(0))
