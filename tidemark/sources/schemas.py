"""Declared schemas: inferring one would read the files a second time."""

LOG_LINES = "level string, datetime string"
VIEWS = "user_id int, chapter_id int"
CHAPTERS = "chapter_id int, course_id int"
TITLES = "course_id int, title string"
EXAM_RESULTS = "subject string, score string"
FREE_TRIALS = (
    "country string, rebill_period int, payments_made int, chapter_access_count int, "
    "seconds_watched int"
)
COMPETITION = "CompetitorID int, Gender string, Age int, Height int, Weight int, NoOfReps int"
CHAPTER_VIEWS = (
    "payment_method_type string, country string, rebill_period_in_months int, firstSub int, "
    "age int, all_time_views int, last_month_views int, next_month_views int, "
    "is_cancelled boolean, observation_date date"
)
COURSE_RATINGS = "userId int, courseId int, proportionWatched double"
# Streams of the test events table.
EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
