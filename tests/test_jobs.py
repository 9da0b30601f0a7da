"""The command line on files like those the jobs are for."""

from __future__ import annotations

import pytest

from test_golden import CHAPTERS, COMPETITION, LOG_B, TITLES, VIEWS
from tidemark.jobs import FILES, STREAMS, main, parser


def csv(header, data):
    return "\n".join([*([header] if header else []), *[",".join(map(str, r)) for r in data]]) + "\n"


HOUSE_HEADER = (
    "id,date,price,bedrooms,bathrooms,sqft_living,sqft_lot,floors,waterfront,view,condition,grade,"
    "sqft_above,yr_built,yr_renovated,zipcode,lat,long,sqft_living15,sqft_lot15"
)
HOUSES = [
    (i, "20150101T0", 1000 * (50 + i % 37 * 10 + i % 4), i % 4, 1 + i % 3, 800 + i % 37 * 50, 4000 + i % 11,
     1 + i % 2, i % 20 == 0 and 1 or 0, 0, i % 3, 5 + i % 4, 700 + i % 37 * 40, 1950 + i % 50, 0,
     98000 + i % 5, 47.5, -122.2, 900 + i % 13, 4100 + i % 17)
    for i in range(150)
]
VIEWS_HEADER = (
    "payment_method_type,country,rebill_period_in_months,firstSub,age,all_time_views,"
    "last_month_views,next_month_views,is_cancelled,observation_date"
)
CHAPTER_VIEWS = [
    (("card", "cash")[i % 2], ("US", "GB")[i % 2], 1, i % 2, 20 + i % 30, i % 40, i % 7, i % 3,
     str(i % 10 == 0).lower(), "2019-01-01")
    for i in range(150)
]
TRIALS_HEADER = "country,rebill_period,payments_made,chapter_access_count,seconds_watched"
RATINGS_HEADER = "userId,courseId,proportionWatched"

INPUTS = {
    "log-report": [LOG_B],
    "course-scores": [csv(None, VIEWS), csv(None, CHAPTERS), csv(None, TITLES)],
    "exam-flags": ["student_id,subject,score\n1,Biology,B\n2,Maths,C\n"],
    "rows-per-key": [LOG_B],
    "repetitions": [COMPETITION],
    "feature-screen": [csv(HOUSE_HEADER, HOUSES)],
    "house-prices": [csv(HOUSE_HEADER, HOUSES)],
    "views-forecast": [csv(VIEWS_HEADER, CHAPTER_VIEWS)],
    "churn": [csv(VIEWS_HEADER, CHAPTER_VIEWS)],
    "conversions": [csv(TRIALS_HEADER, [(("US", "FR")[i % 2], 1, i % 2, i % 9, i * 60) for i in range(80)])],
    "clusters": [COMPETITION],
    "recommendations": [
        csv(RATINGS_HEADER, [(u, c, (u + c) % 10 / 10) for u in range(12) for c in range(9)]),
        csv(RATINGS_HEADER, [(3, 4, 0.5)]),
    ],
    "keywords": ["the cat the dog\n", "the bird\n"],
}
EXPECTED = {
    "log-report": ["|DEBUG|February |1 ", "|INFO |October  |1 "],
    "course-scores": ["|10   |Work faster harder smarter until you drop|"],
    "exam-flags": ["|1         |Biology|B    |false|", "|2         |Maths  |C    |true |"],
    "rows-per-key": ["|DEBUG|4 ", "|3        |"],
    "repetitions": ["(intercept)", "34.47637"],
    "feature-screen": ["|sqft_above", "corr"],
    "house-prices": ["training", "holdout"],
    "views-forecast": ["(intercept)", "training"],
    "churn": ["true_positive_rate", "prediction"],
    "conversions": ["DecisionTreeClassificationModel", "RandomForestClassificationModel", "accuracy"],
    "clusters": ["silhouette", "|7  |"],
    "recommendations": ["|3     |1   |", "|3     |5   |"],
    "keywords": ["|0.txt |dog |1  |", "|1.txt |1       |"],
}


def test_every_job_has_a_case():
    assert INPUTS.keys() == FILES.keys() == EXPECTED.keys()
    for name in STREAMS:
        assert parser().parse_args([name]).run is STREAMS[name]


@pytest.mark.parametrize("job", sorted(INPUTS))
def test_job(spark, tmp_path, capsys, job):
    paths = []
    for i, text in enumerate(INPUTS[job]):
        (tmp_path / f"{i}.txt").write_text(text)
        paths.append(str(tmp_path / f"{i}.txt"))
    if job == "keywords":
        paths = [f"{tmp_path}/*.txt"]
    extra = ["--header", "level,"] if job == "rows-per-key" else []
    main([job, *paths, *extra])
    shown = capsys.readouterr().out
    for text in EXPECTED[job]:
        assert text in shown


def test_whole_reports_are_written(spark, tmp_path, capsys):
    """All 144 groups of twelve levels, not only what fits on a screen; nothing is written over."""
    days = [(f"L{level}", f"2024-{month}-1 10:00:00") for level in range(12) for month in range(1, 13)]
    (tmp_path / "log.csv").write_text(csv("level,datetime", days))
    main(["log-report", str(tmp_path / "log.csv"), "--output", f"{tmp_path}/out"])
    assert spark.read.parquet(f"{tmp_path}/out/months").count() == 144
    assert "L1" not in capsys.readouterr().out
    with pytest.raises(Exception, match="(?i)exist"):
        main(["log-report", str(tmp_path / "log.csv"), "--output", f"{tmp_path}/out"])


def test_live_jobs_need_the_kafka_connector(spark):
    for job in ("live-leaderboard", "live-seconds"):
        with pytest.raises(Exception, match="(?i)kafka"):
            main([job])
