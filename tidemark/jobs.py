"""Command line of the jobs: ``spark-submit jobs.py <job> <files>`` or ``python -m tidemark.jobs``.

With ``--output`` each report is written whole to a folder of its name, otherwise its first rows are
shown; nothing unbounded is brought to the driver.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import field
from tidemark.functions.times import parse_log_time
from tidemark.operators import metrics
from tidemark.operators.aggregates import count_by
from tidemark.operators.features import hash_split, with_row_key
from tidemark.operators.models import importance_rows
from tidemark.operators.statistics import describe_columns
from tidemark.plans import conversions, forecasts, recommendations
from tidemark.plans.clusters import cluster_report
from tidemark.plans.course_popularity import course_scores
from tidemark.plans.exam_flags import pass_flags
from tidemark.plans.keywords import course_keywords
from tidemark.plans.live_views import start_course_leaderboard, viewing_seconds_sql
from tidemark.plans.log_reports import month_report, rows_per_key, start_level_counts
from tidemark.session import build_session, shared_folder
from tidemark.sources import schemas
from tidemark.sources.files import read_csv, read_csv_strings, read_lines
from tidemark.sources.sinks import console_writer
from tidemark.sources.streams import kafka_values, log_levels, socket_lines
from tidemark.streaming.updates import start_updates
from tidemark.streaming.windows import flat_window, with_event_time

SHOWN = 50
STREAM_DELAY = "10 minutes"

# Columns of the house price and chapter view files.
HOUSE_DROPPED = (
    "id", "date", "waterfront", "view", "condition", "grade", "yr_renovated", "zipcode", "lat", "long",
)
HOUSE_DROPPED_LATER = ("sqft_lot", "yr_built", "sqft_lot15", "sqft_living15")
HOUSE_NUMERIC = ("bedrooms", "bathrooms", "sqft_living", "sqft_above_percentage", "floors", "waterfront")
HOUSE_CATEGORICAL = ("condition", "grade", "zipcode")
VIEWS_NUMERIC = ("firstSub", "all_time_views", "last_month_views")
CHURN_NUMERIC = ("firstSub", "age", "all_time_views", "last_month_views")
VIEWS_CATEGORICAL = ("payment_method_type", "country", "rebill_period_in_months")
GYM_NUMERIC = ("Age", "Height", "Weight")


def show(df: DataFrame, rows: int = SHOWN) -> None:
    df.show(rows, truncate=False)


def deliver(args: argparse.Namespace, **reports: DataFrame) -> None:
    """Write all rows of the reports below ``--output``, or show the first of each without it."""
    for name, report in reports.items():
        if args.output:
            report.write.parquet(f"{args.output.rstrip('/')}/{name}")
        else:
            show(report)


def log_report(spark: SparkSession, args: argparse.Namespace) -> None:
    """Log lines by level and month."""
    log = read_csv_strings(spark, args.log)
    deliver(args, months=month_report(log.withColumn("datetime", parse_log_time(F.col("datetime")))))


def score_courses(spark: SparkSession, args: argparse.Namespace) -> None:
    """Courses by popularity."""
    views = read_csv(spark, args.views, schemas.VIEWS, header=False)
    chapters = read_csv(spark, args.chapters, schemas.CHAPTERS, header=False)
    titles = read_csv(spark, args.titles, schemas.TITLES, header=False)
    deliver(args, scores=course_scores(views, chapters, titles))


def flag_exams(spark: SparkSession, args: argparse.Namespace) -> None:
    """Exam results with a pass flag."""
    deliver(args, flags=pass_flags(read_csv_strings(spark, args.results)))


def profile_keys(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rows per first field of a log."""
    lines = read_lines(spark, args.log, args.header)
    sizes, number = rows_per_key(lines.select(field(F.col("value"), 0, args.delimiter).alias("key")), "key")
    deliver(args, keys=sizes.orderBy(F.desc("key_rows")), number=number)


def live_levels(spark: SparkSession, args: argparse.Namespace) -> None:
    """Lines per level in the last two minutes, from a socket."""
    lines = log_levels(socket_lines(spark, args.host, args.port))
    logs = with_event_time(lines, "timestamp", STREAM_DELAY)
    query = start_level_counts(logs, args.output, args.checkpoint, report=show, interval="2 seconds")
    query.awaitTermination()


def live_leaderboard(spark: SparkSession, args: argparse.Namespace) -> None:
    """Courses by viewing time in the last hour, from Kafka."""
    views = kafka_values(spark, args.servers, [args.topic], "course_name", group_id=args.group)
    views = with_event_time(views, "timestamp", STREAM_DELAY)
    query = start_course_leaderboard(
        views, args.output, args.checkpoint, "course_name", "timestamp", report=show, interval="1 second"
    )
    query.awaitTermination()


def live_seconds(spark: SparkSession, args: argparse.Namespace) -> None:
    """Viewing time per course and two minutes from Kafka: as updates, or on the console without --output."""
    views = kafka_values(spark, args.servers, [args.topic], group_id=args.group)
    seconds = viewing_seconds_sql(spark, with_event_time(views, "timestamp", STREAM_DELAY), "value", "timestamp")
    if args.output:
        keys = ["window_start", "window_end", "course_name"]
        query = start_updates(flat_window(seconds), args.output, args.checkpoint, "1 second", keys)
    else:
        query = console_writer(seconds).option("checkpointLocation", args.checkpoint).start()
    query.awaitTermination()


def predict_repetitions(spark: SparkSession, args: argparse.Namespace) -> None:
    """Regression of competition repetitions."""
    data = read_csv(spark, args.competition, schemas.COMPETITION)
    model = forecasts.linear_fit(data, "NoOfReps", GYM_NUMERIC, ["Gender"])
    fit = metrics.regression_metrics(model.transform(data), "NoOfReps")
    deliver(args, weights=forecasts.linear_weights(model, data), fit=fit)


def screen_houses(spark: SparkSession, args: argparse.Namespace) -> None:
    """Correlations among house features."""
    houses = read_csv(spark, args.houses, None)
    found = forecasts.screen_features(houses, "price", HOUSE_DROPPED, HOUSE_DROPPED_LATER)
    pairs = found.select("col_a", "col_b", "corr", "step")
    deliver(args, summary=describe_columns(houses, houses.columns), pairs=pairs)


def predict_prices(spark: SparkSession, args: argparse.Namespace) -> None:
    """Searched regression of house prices."""
    houses = read_csv(spark, args.houses, None)
    share = F.try_divide("sqft_above", "sqft_living")
    model = forecasts.searched_regression(
        houses.withColumn("sqft_above_percentage", share), "id", "price", HOUSE_NUMERIC, HOUSE_CATEGORICAL
    )
    deliver(args, candidates=model.candidates(), fit=forecasts.regression_report(model, "price"))


def forecast_views(spark: SparkSession, args: argparse.Namespace) -> None:
    """Searched regression of next month's chapter views."""
    views = with_row_key(forecasts.clean_chapter_views(read_csv(spark, args.views, schemas.CHAPTER_VIEWS)))
    model = forecasts.searched_regression(
        forecasts.with_views_label(views), "row_key", "label", VIEWS_NUMERIC, VIEWS_CATEGORICAL,
        forecasts.VIEWS_GRID, train_tenths=9,
    )
    fit = forecasts.regression_report(model, "label")
    deliver(args, candidates=model.candidates(), weights=model.weights(), fit=fit)


def predict_churn(spark: SparkSession, args: argparse.Namespace) -> None:
    """Searched classification of inactive customers."""
    views = with_row_key(forecasts.clean_chapter_views(read_csv(spark, args.views, schemas.CHAPTER_VIEWS)))
    model = forecasts.searched_churn(
        forecasts.with_inactive_label(views), "row_key", CHURN_NUMERIC, VIEWS_CATEGORICAL
    )
    rates, confusion = forecasts.churn_report(model)
    deliver(args, candidates=model.candidates(), rates=rates, confusion=confusion)


def convert_trials(spark: SparkSession, args: argparse.Namespace) -> None:
    """Decision tree and random forest of trial conversion."""
    trials = conversions.labelled_trials(read_csv(spark, args.trials, schemas.FREE_TRIALS))
    training, holdout = hash_split(with_row_key(trials), "row_key")
    for kind in ("tree", "forest"):
        model = conversions.fit_conversion(training, kind)
        print(conversions.rules_text(model))
        names = ["country_index", *conversions.USAGE]
        reports = {
            f"{kind}_countries": conversions.country_indexes(model, training),
            f"{kind}_importance": importance_rows(model.stages[-1], training, names),
            f"{kind}_accuracy": metrics.accuracy(model.transform(holdout)),
        }
        deliver(args, **reports)


def cluster_competitors(spark: SparkSession, args: argparse.Namespace) -> None:
    """Two to seven clusters of competitors."""
    data = read_csv(spark, args.competition, schemas.COMPETITION)
    deliver(args, clusters=cluster_report(data, [*GYM_NUMERIC, "NoOfReps"], ["Gender"]))


def recommend_courses(spark: SparkSession, args: argparse.Namespace) -> None:
    """Predicted ratings and five courses for the users of a second file."""
    columns = ("userId", "courseId", "proportionWatched")
    rated = recommendations.percent_ratings(read_csv(spark, args.ratings, schemas.COURSE_RATINGS), *columns)
    users = read_csv(spark, args.users, schemas.COURSE_RATINGS)
    model = recommendations.fit_recommender(rated, *columns)
    best = recommendations.top_items(model, users).orderBy("userId", "rank")
    deliver(args, predictions=recommendations.score(model, users), recommendations=best)


def find_keywords(spark: SparkSession, args: argparse.Namespace) -> None:
    """Words of courses that not all of them use, from files named by course."""
    lines = read_lines(spark, args.texts).withColumn("course", F.col("_metadata.file_name"))
    keywords = course_keywords(lines, "course", "value")
    numbers = count_by(keywords, "course", name="keywords").orderBy("course")
    deliver(args, keywords=keywords.orderBy(F.desc("n"), "course", "word"), numbers=numbers)


FILES = {
    "log-report": (log_report, ["log"]),
    "course-scores": (score_courses, ["views", "chapters", "titles"]),
    "exam-flags": (flag_exams, ["results"]),
    "rows-per-key": (profile_keys, ["log"]),
    "repetitions": (predict_repetitions, ["competition"]),
    "feature-screen": (screen_houses, ["houses"]),
    "house-prices": (predict_prices, ["houses"]),
    "views-forecast": (forecast_views, ["views"]),
    "churn": (predict_churn, ["views"]),
    "conversions": (convert_trials, ["trials"]),
    "clusters": (cluster_competitors, ["competition"]),
    "recommendations": (recommend_courses, ["ratings", "users"]),
    "keywords": (find_keywords, ["texts"]),
}
STREAMS: dict[str, Callable] = {
    "live-levels": live_levels,
    "live-leaderboard": live_leaderboard,
    "live-seconds": live_seconds,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    top.add_argument("--master", help="Spark master, if spark-submit does not set it")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (run, files) in FILES.items():
        job = jobs.add_parser(name, help=run.__doc__)
        for file in files:
            job.add_argument(file, help="path or glob")
        job.add_argument("--output", help="folder for whole reports as Parquet; must not hold them yet")
        job.set_defaults(run=run)
        if name == "rows-per-key":
            job.add_argument("--delimiter", default=",")
            job.add_argument("--header", help="beginning of the header line, if there is one")
    for name, run in STREAMS.items():
        job = jobs.add_parser(name, help=run.__doc__)
        if name == "live-levels":
            job.add_argument("--host", default="localhost")
            job.add_argument("--port", type=int, default=8989)
        else:
            job.add_argument("--servers", default="localhost:9092")
            job.add_argument("--topic", default="views")
            job.add_argument("--group", help="Kafka group id")
        job.add_argument("--output", help="folder of the results")
        job.add_argument("--checkpoint", help="folder of the progress; give the same to go on")
        job.set_defaults(run=run)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tidemark {args.job}", args.master)
    if args.job in STREAMS:
        if args.job != "live-seconds":
            args.output = args.output or shared_folder(spark, f"{args.job}-output")
        args.checkpoint = args.checkpoint or shared_folder(spark, f"{args.job}-checkpoint")
    args.run(spark, args)


if __name__ == "__main__":
    main()
