"""Jobs on small known inputs with known results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.times import parse_log_time
from tidemark.operators.features import string_indexer
from tidemark.operators.metrics import regression_metrics
from tidemark.plans.clusters import cluster_report
from tidemark.plans.conversions import country_indexes, fit_conversion, labelled_trials, rules_text
from tidemark.plans.course_popularity import course_scores
from tidemark.plans.forecasts import linear_fit, linear_weights
from tidemark.plans.log_reports import month_report, month_report_sql
from tidemark.sources import schemas
from tidemark.sources.files import read_csv

# Known inputs.
VIEWS = [(14, 96), (14, 97), (13, 96), (13, 96), (13, 96), (14, 99), (13, 100)]
CHAPTERS = [(96, 1), (97, 1), (98, 1), (99, 2), *[(c, 3) for c in range(100, 110)]]
TITLES = [
    (1, "How to find a better job"),
    (2, "Work faster harder smarter until you drop"),
    (3, "Content Creation is a Mug's Game"),
]
LOG_A = [
    ("WARN", "2016-12-31 04:19:32"),
    ("FATAL", "2016-12-31 03:22:34"),
    ("WARN", "2016-12-31 03:21:21"),
    ("INFO", "2015-4-21 14:32:21"),
    ("FATAL", "2015-4-21 19:23:20"),
]
LOG_B = """level,datetime
DEBUG,2015-2-6 16:24:07
WARN,2016-7-26 18:54:43
INFO,2012-10-18 14:35:19
DEBUG,2012-4-26 14:26:50
DEBUG,2013-9-28 20:27:13
INFO,2017-8-20 13:17:27
INFO,2015-4-13 09:28:17
DEBUG,2015-7-17 00:49:27"""
COMPETITION = """CompetitorID,Gender,Age,Height,Weight,NoOfReps
1,M,23,180,88,55
2,M,18,169,84,54
3,M,25,174,70,49
4,F,24,166,60,44
5,F,24,180,78,52
6,M,25,171,89,60
7,F,18,179,80,54
8,F,23,164,70,52
9,F,21,166,58,46
10,M,20,185,77,52
11,M,24,179,81,54
12,M,19,171,88,56
13,F,22,176,57,44
14,F,23,163,65,45
15,F,23,174,74,53
16,M,25,187,87,54
17,M,25,189,84,52
18,F,20,172,79,49
19,F,21,177,65,47
20,M,20,171,70,50
"""
COUNTRY_COUNTS = {"US": 270, "CA": 247, "IN": 220, "UNKNOWN": 177, "DE": 87, "GB": 41}


def timed(log):
    return log.withColumn("datetime", parse_log_time(F.col("datetime")))


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_course_scores(spark, broadcast_rows):
    """The same ranking whether the chapters are broadcast or joined with salted keys."""
    scores = course_scores(
        spark.createDataFrame(VIEWS, schemas.VIEWS),
        spark.createDataFrame(CHAPTERS, schemas.CHAPTERS),
        spark.createDataFrame(TITLES, schemas.TITLES),
        broadcast_rows=broadcast_rows,
    )
    assert [tuple(r) for r in scores.collect()] == [
        (10, TITLES[1][1]),
        (6, TITLES[0][1]),
        (0, TITLES[2][1]),
    ]


def test_courses_without_views_or_title_vanish(spark):
    scores = course_scores(
        spark.createDataFrame([(1, 1), (1, 2)], schemas.VIEWS),
        spark.createDataFrame([(1, 1), (2, 2), (3, 3)], schemas.CHAPTERS),
        spark.createDataFrame([(1, "one"), (3, "three")], schemas.TITLES),
    )
    assert [tuple(r) for r in scores.collect()] == [(10, "one")]


def test_month_report(spark):
    log = timed(spark.createDataFrame(LOG_A, schemas.LOG_LINES))
    wanted = [("FATAL", "April", 1), ("INFO", "April", 1), ("FATAL", "December", 1), ("WARN", "December", 2)]
    assert [tuple(r) for r in month_report(log).collect()] == wanted
    report = month_report_sql(spark, log).select("level", "month", "total")
    assert [tuple(r) for r in report.collect()] == wanted


def test_month_report_from_a_file(spark, tmp_path):
    (tmp_path / "log.txt").write_text(LOG_B)
    log = timed(read_csv(spark, str(tmp_path / "log.txt"), schemas.LOG_LINES))
    assert [tuple(r) for r in month_report(log).collect()] == [
        ("DEBUG", "February", 1),
        ("DEBUG", "April", 1),
        ("INFO", "April", 1),
        ("DEBUG", "July", 1),
        ("WARN", "July", 1),
        ("INFO", "August", 1),
        ("DEBUG", "September", 1),
        ("INFO", "October", 1),
    ]
    assert month_report(log, rows=3).count() == 3


@pytest.fixture
def trials(spark):
    data = [
        (country, (1, 6, 12)[i % 3], i % 2, i % 7, 100 * i)
        for country, count in COUNTRY_COUNTS.items()
        for i in range(count)
    ]
    return spark.createDataFrame(data, schemas.FREE_TRIALS)


def test_country_groups_and_their_index_order(spark, trials):
    labelled = labelled_trials(trials)
    model = string_indexer(["country"]).fit(labelled)
    assert list(model.labelsArray[0]) == ["US", "OTHER", "IN", "UNKNOWN", "EUROPE", "GB"]
    assert labelled.where("label = payments_made").count() == sum(COUNTRY_COUNTS.values())


@pytest.mark.parametrize("kind", ["tree", "tree_regression", "forest"])
def test_conversion_models(spark, trials, rows, kind):
    training = labelled_trials(trials)
    model = fit_conversion(training, kind)
    scored = model.transform(training)
    if kind != "tree_regression":
        assert {r[0] for r in scored.select("prediction").distinct().collect()} <= {0.0, 1.0}
        majority = max(r[1] for r in training.groupBy("label").count().collect()) / training.count()
        assert scored.where("prediction = label").count() / training.count() >= majority
    again = fit_conversion(training, kind).transform(training)
    assert rows(scored.groupBy("prediction").count()) == rows(again.groupBy("prediction").count())
    assert "If (feature" in rules_text(model) or "Predict" in rules_text(model)
    assert {r.value for r in country_indexes(model, training).collect()} == {
        "US", "OTHER", "IN", "UNKNOWN", "EUROPE", "GB"
    }


@pytest.fixture
def competition(spark, tmp_path):
    (tmp_path / "competition.csv").write_text(COMPETITION)
    return read_csv(spark, str(tmp_path / "competition.csv"), schemas.COMPETITION)


def test_repetitions_regression(competition):
    model = linear_fit(competition, "NoOfReps", ["Age", "Height", "Weight"], ["Gender"])
    weights = {r.feature: round(r.weight, 6) for r in linear_weights(model, competition).collect()}
    assert weights == {
        "(intercept)": 34.476378,
        "Age": 0.044139,
        "Height": -0.080315,
        "Weight": 0.396073,
        "Gender_vector_F": -0.223621,
    }
    quality = regression_metrics(model.transform(competition), "NoOfReps").first()
    assert (quality.rows, round(quality.r2, 6), round(quality.rmse, 6)) == (20, 0.840619, 1.669603)


def test_cluster_sweep(competition):
    report = cluster_report(competition, ["Age", "Height", "Weight", "NoOfReps"], ["Gender"]).collect()
    for k in range(2, 8):
        lines = [r for r in report if r.k == k]
        assert [r.cluster for r in lines] == list(range(k))
        assert sum(r.size for r in lines) == 20
        assert len({(r.sse, r.silhouette) for r in lines}) == 1
        assert lines[0].sse > 0 and -1 <= lines[0].silhouette <= 1
    assert len(report) == 27
