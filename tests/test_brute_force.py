"""Jobs against plain loops on random small inputs."""

from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.plans.course_popularity import course_scores
from tidemark.plans.keywords import course_keywords
from tidemark.sources import schemas

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ids = st.integers(min_value=1, max_value=6)


def scores_by_loop(views, chapters, titles):
    course_of = defaultdict(list)
    for chapter, course in chapters:
        course_of[chapter].append(course)
    sizes = Counter(course for _, course in chapters)
    seen = Counter((user, course) for user, chapter in set(views) for course in course_of[chapter])
    points = Counter()
    for (_, course), n in seen.items():
        share = n / sizes[course]
        points[course] += 10 if share > 0.9 else 4 if share > 0.5 else 2 if share > 0.25 else 0
    return sorted((points[c], title) for c, title in titles if c in points)


@few
@given(
    st.lists(st.tuples(ids, st.integers(1, 12)), min_size=1, max_size=60),
    st.lists(st.tuples(st.integers(1, 12), ids), min_size=1, max_size=20),
    st.sampled_from([0, 1000]),
)
def test_course_scores(spark, views, chapters, broadcast_rows):
    titles = [(c, f"title {c}") for c in range(1, 6)]
    found = course_scores(
        spark.createDataFrame(views, schemas.VIEWS),
        spark.createDataFrame(chapters, schemas.CHAPTERS),
        spark.createDataFrame(titles, schemas.TITLES),
        broadcast_rows=broadcast_rows,
    )
    assert sorted(tuple(r) for r in found.collect()) == scores_by_loop(views, chapters, titles)


@few
@given(st.lists(st.tuples(st.sampled_from("xyz"), st.text("ab \n", max_size=12)), min_size=1, max_size=12))
def test_course_keywords(spark, texts):
    counts = Counter((course, word) for course, text in texts for word in text.split())
    used = defaultdict(set)
    for course, word in counts:
        used[word].add(course)
    courses = {course for course, _ in counts}
    wanted = sorted((c, w, n) for (c, w), n in counts.items() if used[w] != courses)
    found = course_keywords(spark.createDataFrame(texts, "course string, text string"), "course")
    assert sorted(tuple(r) for r in found.collect()) == wanted
