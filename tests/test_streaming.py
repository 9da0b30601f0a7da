"""Streams give what the same aggregate gives on a batch, whatever the batches look like."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans.live_views import (
    start_course_leaderboard,
    viewing_last_hour,
    viewing_seconds,
    viewing_seconds_sql,
)
from tidemark.plans.log_reports import live_level_counts, start_level_counts
from tidemark.session import shared_folder, state_on_disk
from tidemark.sources.files import folder_names
from tidemark.sources.sinks import console_writer, start_append
from tidemark.sources.streams import parquet_stream
from tidemark.streaming.late_rows import count_late_rows, observed
from tidemark.streaming.leaderboard import (
    ranking,
    read_leaderboard,
    step_changes,
    step_sums,
    summed,
    write_leaderboard,
)
from tidemark.streaming.updates import latest_per_key, read_latest, rewrite_latest, start_updates, write_updates
from tidemark.streaming.windows import closed_windows, flat_window, sliding_sum, tumbling_sum, with_event_time

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, course string"


def at(seconds):
    """Literal of a time in the events, whatever the time zone of this machine."""
    return F.lit(str(START + timedelta(seconds=seconds))).cast("timestamp_ntz")


def heartbeats(*seconds_and_courses):
    return [(START + timedelta(seconds=s), c) for s, c in seconds_and_courses]


# Three files; the second reaches back before the end of the first.
FILES = [
    heartbeats((0, "a"), (70, "a"), (130, "b"), (600, "c")),
    heartbeats((100, "a"), (500, "a"), (3000, "b"), (3001, "b")),
    heartbeats((2990, "a"), (3500, "b"), (4000, "a"), (7300, "c")),
]


@pytest.fixture
def files(spark, tmp_path):
    """Function that writes one parquet file per list of rows, in order, and gives the folder."""

    def write(*lists):
        for i, data in enumerate(lists):
            frame = spark.createDataFrame(data, SCHEMA).coalesce(1)
            frame.write.parquet(f"{tmp_path}/in/{i}")
        return f"{tmp_path}/in/*"

    return write


def stream(spark, path, delay="10 minutes"):
    return with_event_time(parquet_stream(spark, path, SCHEMA, files_per_batch=1), "ts", delay)


def batches(query) -> int:
    return len([p for p in query.recentProgress if p.numInputRows > 0])


def test_updates_of_many_batches_merge_to_the_batch_result(spark, files, rows, tmp_path):
    path = files(*FILES)
    seconds = flat_window(viewing_seconds(stream(spark, path, "2 hours"), "course", "ts"))
    query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert batches(query) == 3
    found = read_latest(spark, f"{tmp_path}/out", ["window_start", "window_end", "course"])
    wanted = flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts"))
    assert rows(found) == rows(wanted)
    # A window that changed in several batches was written in each of them.
    assert spark.read.parquet(f"{tmp_path}/out").count() > wanted.count()


def test_stream_goes_on_in_a_rewritten_table(spark, files, rows, tmp_path):
    path = files(*FILES[:2])
    keys = ["window_start", "window_end", "course"]

    def run(folder):
        seconds = flat_window(viewing_seconds(stream(spark, path, "2 hours"), "course", "ts"))
        start_updates(seconds, folder, f"{tmp_path}/checkpoint").awaitTermination()

    run(f"{tmp_path}/old")
    rewrite_latest(spark, f"{tmp_path}/old", f"{tmp_path}/new", keys)
    assert rows(read_latest(spark, f"{tmp_path}/new", keys)) == rows(read_latest(spark, f"{tmp_path}/old", keys))
    spark.createDataFrame(FILES[2], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/9")
    run(f"{tmp_path}/new")
    wanted = flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts"))
    assert rows(read_latest(spark, f"{tmp_path}/new", keys)) == rows(wanted)


def test_sql_over_a_streaming_view(spark, files, rows, tmp_path):
    path = files(*FILES)
    seconds = flat_window(viewing_seconds_sql(spark, stream(spark, path, "2 hours"), "course", "ts"))
    start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    found = read_latest(spark, f"{tmp_path}/out", ["window_start", "window_end", "course_name"])
    wanted = flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts"))
    assert rows(found) == rows(wanted)


def test_last_hour_appends_each_closed_window_once(spark, files, rows, tmp_path):
    path = files(*FILES)
    with state_on_disk(spark):
        hours = flat_window(viewing_last_hour(stream(spark, path, "2 hours"), "course", "ts"))
        start_append(hours, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    found = spark.read.schema(hours.schema).parquet(f"{tmp_path}/out")
    everything = flat_window(viewing_last_hour(spark.read.parquet(path), "course", "ts"))
    closed = everything.where(F.col("window_end") <= at(100))
    assert rows(found) == rows(closed)
    assert closed.count() > 0


def test_level_counts_slide(spark, files, rows):
    path = files(heartbeats((0, "WARN"), (1, "WARN"), (3, "INFO")))
    found = flat_window(live_level_counts(spark.read.parquet(path), "course", "ts"))
    assert found.count() == 120
    full = found.where(F.col("window_start") == at(0)).select("course", "total")
    assert rows(full) == [("INFO", 1), ("WARN", 2)]


def test_two_steps_equal_direct_sliding(spark, files, rows):
    events = spark.read.parquet(files(*FILES))
    found = sliding_sum(events, "ts", "10 minutes", "2 minutes", ["course"], F.lit(5), "s")
    direct = events.groupBy(F.window("ts", "10 minutes", "2 minutes"), "course").agg(
        F.sum(F.lit(5)).alias("s")
    )
    assert rows(flat_window(found)) == rows(flat_window(direct))
    long = sliding_sum(events, "ts", "3 days", "7 hours 12 minutes", ["course"], F.lit(5), "s")
    direct = events.groupBy(F.window("ts", "3 days", "7 hours 12 minutes"), "course").agg(F.sum(F.lit(5)).alias("s"))
    assert rows(flat_window(long)) == rows(flat_window(direct))


def test_row_behind_the_watermark_is_dropped(spark, files, tmp_path):
    """The watermark moves after batch 1, applies from batch 2 on, and drops the row of batch 3."""
    path = files(
        heartbeats((0, "a"), (1800, "a")), heartbeats((1810, "a"), (1815, "b")), heartbeats((40, "a"))
    )
    seconds = flat_window(viewing_seconds(stream(spark, path), "course", "ts"))
    query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    dropped = sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
    assert dropped == 1
    found = read_latest(spark, f"{tmp_path}/out", ["window_start", "window_end", "course"])
    first = found.where(F.col("window_start") == at(0)).first()
    assert first.seconds_watched == 5


def test_late_rows_are_counted(spark, files, tmp_path):
    """Three rows behind the watermark, and one without a time."""
    late = [*heartbeats((40, "a"), (200, "a"), (40, "b")), (None, "a")]
    path = files(heartbeats((0, "a"), (1800, "a")), heartbeats((1810, "a")), late)
    listener = count_late_rows(spark)
    try:
        seconds = flat_window(viewing_seconds(observed(stream(spark, path), "ts"), "course", "ts"))
        query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination()
        assert listener.settled(query)
    finally:
        spark.streams.removeListener(listener)
    assert listener.late(query) == 3
    by_batch = {b.number: (b.rows, b.late) for b in listener.batches(query) if b.rows}
    assert by_batch == {0: (2, 0), 1: (1, 0), 2: (4, 3)}
    last = [b for b in listener.batches(query) if b.number == 2][0]
    assert (last.times["n_rows"], last.times["n_without_time"]) == (4, 1)


def test_state_is_released_behind_the_watermark(spark, files, tmp_path):
    path = files(*[heartbeats((3600 * i, "a"), (3600 * i + 1, "b")) for i in range(6)])
    seconds = flat_window(viewing_seconds(stream(spark, path), "course", "ts"))
    query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 6
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4


def test_query_goes_on_from_its_checkpoint(spark, files, rows, tmp_path):
    path = files(*FILES[:2])
    for data in (None, FILES[2]):
        if data is not None:
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/9")
        seconds = flat_window(viewing_seconds(stream(spark, path, "2 hours"), "course", "ts"))
        query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        query.awaitTermination()
    assert batches(query) == 1
    found = read_latest(spark, f"{tmp_path}/out", ["window_start", "window_end", "course"])
    wanted = flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts"))
    assert rows(found) == rows(wanted)


def test_state_on_disk_gives_the_same_windows(spark, files, rows, tmp_path):
    """The state store that clusters use."""
    path = files(*FILES)
    with state_on_disk(spark):
        seconds = flat_window(viewing_seconds(stream(spark, path, "2 hours"), "course", "ts"))
        start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    found = read_latest(spark, f"{tmp_path}/out", ["window_start", "window_end", "course"])
    assert rows(found) == rows(flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts")))


def test_sliding_sums_of_a_stream_over_many_batches(spark, files, rows, tmp_path):
    """From state: every closed window once, with late and null keys, numbers with fractions, and a restart."""
    draw = random.Random(1)
    lists = [heartbeats(*[(600 * i + draw.randint(-200, 900), draw.choice(["a", "b", None])) for _ in range(15)]) for i in range(5)]
    path, size, slide = files(*lists[:3]), "10 minutes", "2 minutes"
    value = F.second("ts") + F.lit(0.5)
    with state_on_disk(spark):
        for more in (None, lists[3], lists[4]):
            if more is not None:
                spark.createDataFrame(more, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{9 + len(folder_names(spark, f'{tmp_path}/in'))}")
            sums = sliding_sum(stream(spark, path, "20 minutes"), "ts", size, slide, ["course"], value, "s")
            query = start_append(flat_window(sums), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
            query.awaitTermination()
    everything = flat_window(sliding_sum(spark.read.parquet(path), "ts", size, slide, ["course"], value, "s"))
    last = spark.read.parquet(path).agg(F.max("ts")).first()[0] - timedelta(minutes=20)
    closed = everything.where(F.col("window_end") <= F.lit(str(last)).cast("timestamp_ntz"))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(closed) and closed.count() >= 50
    plan = query._jsq.explainInternal(False)
    assert "TransformWithState" in plan and "Expand" not in plan and "Generate" not in plan


def test_windows_of_slides(rows):
    draw = np.random.default_rng(2)
    for _ in range(50):
        starts = np.unique(draw.integers(-30, 60, draw.integers(0, 20))) * 5
        parts = draw.integers(1, 9, len(starts))
        after, until = sorted(draw.integers(-200, 400, 2).tolist())
        ends, sums = closed_windows(starts, parts, 40, 5, after, until)
        want = {
            e: sum(p for s, p in zip(starts.tolist(), parts.tolist(), strict=True) if e - 40 <= s < e)
            for e in range(-400, 600, 5)
            if after < e <= until
        }
        assert dict(zip(ends.tolist(), sums.tolist(), strict=True)) == {e: s for e, s in want.items() if s}


def test_latest_per_key(spark, rows):
    data = [("a", 1, 0), ("a", 3, 10), ("a", 2, 9), ("b", 7, 0)]
    updates = spark.createDataFrame(data, "k string, v int, batch_id int")
    assert rows(latest_per_key(updates, ["k"])) == [("a", 3), ("b", 7)]


def test_update_table_reads_no_more_as_it_goes_on(spark, rows, tmp_path):
    """Over 60 batches a reader opens a bounded number of folders, and values stay the latest ones."""
    path, latest, opened = f"{tmp_path}/out", {}, []
    handle = write_updates(path, ["k"], compact_every=5)
    for i in range(60):
        changed = {f"k{j}": 100 * i + j for j in range(40) if (i + j) % 7 == 0 or i == 0}
        latest.update(changed)
        handle(spark.createDataFrame(list(changed.items()), "k string, v long").coalesce(1), i)
        if i % 4 == 3 or i > 50:
            found = read_latest(spark, path, ["k"])
            assert {r.k: r.v for r in found.collect()} == latest
            opened.append(len({f.rsplit("/", 1)[0] for f in found.inputFiles()}))
    assert max(opened) <= 5 and len(folder_names(spark, path)) <= 5 + 5 + 2
    assert len(folder_names(spark, f"{path}/_snapshots")) == 2


def test_update_table_takes_repeated_batches(spark, rows, tmp_path):
    """A batch that runs again, also one that made a snapshot, changes nothing; a failed snapshot is not read."""
    path = f"{tmp_path}/out"
    handle = write_updates(path, ["k"], compact_every=2)
    batches = [[("a", 1), ("b", 1)], [("b", 2)], [("c", 3)], [("a", 4)], [("b", 5)]]
    frames = [spark.createDataFrame(b, "k string, v long") for b in batches]
    for i in (0, 1, 1, 2, 3, 3):
        handle(frames[i], i)
    assert rows(read_latest(spark, path, ["k"])) == [("a", 4), ("b", 2), ("c", 3)]
    reader = read_latest(spark, path, ["k"])  # planned before the next snapshot
    spark.createDataFrame([("x", 9)], "k string, v long").write.parquet(f"{path}/_snapshots/batch_id=5")
    handle(frames[4], 4)
    assert rows(read_latest(spark, path, ["k"])) == [("a", 4), ("b", 5), ("c", 3)]
    handle(spark.createDataFrame([("d", 6)], "k string, v long"), 5)
    assert rows(reader) == [("a", 4), ("b", 2), ("c", 3)]
    assert rows(read_latest(spark, path, ["k"])) == [("a", 4), ("b", 5), ("c", 3), ("d", 6)]


def test_stream_with_snapshots_goes_on(spark, files, rows, tmp_path):
    """Snapshots of a real stream, over a restart, hold what the batch result holds."""
    path, keys = files(*FILES[:2]), ["window_start", "window_end", "course"]
    for more in (None, FILES[2]):
        if more is not None:
            spark.createDataFrame(more, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/9")
        seconds = flat_window(viewing_seconds(stream(spark, path, "2 hours"), "course", "ts"))
        query = start_updates(seconds, f"{tmp_path}/out", f"{tmp_path}/checkpoint", keys=keys, compact_every=2)
        query.awaitTermination()
        wanted = flat_window(viewing_seconds(spark.read.parquet(path), "course", "ts"))
        assert rows(read_latest(spark, f"{tmp_path}/out", keys)) == rows(wanted)
    assert "_latest" in folder_names(spark, f"{tmp_path}/out")


def test_leaderboard_after_every_batch(spark, files, rows, tmp_path):
    path = files(*FILES)
    base = f"{tmp_path}/out"
    events = stream(spark, path, "2 hours")
    reported = []
    query = start_course_leaderboard(
        events, base, f"{tmp_path}/checkpoint", "course", "ts", rows=2,
        report=lambda board: reported.append([tuple(r)[:2] for r in board.collect()]),
    )
    query.awaitTermination()
    assert batches(query) == 3

    def expected(count, end):
        data = [r for f in FILES[:count] for r in f if end - timedelta(hours=1) <= r[0] < end]
        sums = {c: 5 * sum(1 for r in data if r[1] == c) for _, c in data}
        return sorted(sums.items(), key=lambda item: (-item[1], item[0]))[:2]

    ends = [START + timedelta(minutes=m) for m in (11, 51, 122)]
    for batch, end in enumerate(ends):
        board = spark.read.parquet(f"{base}/boards/batch_id={batch}")
        ordered = board.orderBy(F.desc("seconds_watched"), "course")
        found = [(r.course, r.seconds_watched) for r in ordered.collect()]
        assert found == expected(batch + 1, end) == reported[batch]
        assert {r.window_end for r in board.collect()} == {end}
    assert rows(read_leaderboard(spark, base)) == rows(spark.read.parquet(f"{base}/boards/batch_id=2"))


def test_leaderboard_batch_can_be_repeated(spark, rows, tmp_path):
    """A batch that runs again after a failure changes nothing, and an empty one keeps the ranking."""
    base = f"{tmp_path}/out"
    parts = [step_sums(spark.createDataFrame(f, SCHEMA), "ts", "1 minute", "course", F.lit(5), "n") for f in FILES]
    empty = parts[0].select("course", "n", "window_end").limit(0)
    empty.write.parquet(f"{base}/boards/batch_id=-1")
    handle = write_leaderboard(spark, base, "course", "n")
    handle(parts[0], 0)
    handle(parts[1], 1)
    once = rows(spark.read.parquet(f"{base}/boards/batch_id=1"))
    handle(parts[1], 1)
    assert rows(spark.read.parquet(f"{base}/boards/batch_id=1")) == once
    handle(parts[0].limit(0), 2)
    assert rows(spark.read.parquet(f"{base}/boards/batch_id=2")) == once


def test_leaderboard_reads_no_more_as_it_goes_on(spark, rows, tmp_path):
    """Over 50 batches folders are compacted and removed, and rankings stay those of all steps."""
    base, keys = f"{tmp_path}/out", 120
    data = [(START + timedelta(seconds=30 * i), f"c{i % keys}") for i in range(55 * 4)]
    parts = [
        step_sums(spark.createDataFrame(data[: 4 * i + 4], SCHEMA), "ts", "1 minute", "course", F.lit(5), "n")
        .where(F.col("window_start") >= at(120 * i - 60))
        for i in range(55)
    ]
    parts[0].select("course", "n", "window_end").limit(0).write.parquet(f"{base}/boards/batch_id=-1")
    handle = write_leaderboard(spark, base, "course", "n", size=timedelta(hours=3), compact_every=5)
    for i, part in enumerate(parts):
        handle(part, i)
    handle(parts[-1], 54)
    board = read_leaderboard(spark, base)
    wanted = {f"c{k}": 5 * sum(1 for _, c in data if c == f"c{k}") for k in range(keys)}
    assert {r.course: r.n for r in board.collect()} == wanted
    for folder, most in (("steps", 11), ("boards", 11), ("compacted", 2)):
        assert len(folder_names(spark, f"{base}/{folder}")) <= most


def test_leaderboard_by_changes_equals_all_steps(spark, tmp_path):
    """Over random batches, with late and replaced steps, jumps in time and a repeated batch."""
    draw, base = random.Random(3), f"{tmp_path}/out"
    rows, now, parts = {}, 0, []
    schema = "window_start timestamp_ntz, window_end timestamp_ntz, course string, n long"
    for _ in range(14):
        now += draw.choice([0, 1, 3, 20, 70])
        changed = {}
        for _ in range(draw.choice([0, 1, 6])):
            step = (max(0, now - draw.choice([0, 0, 1, 5, 30, 100])), f"c{draw.randrange(6)}")
            changed[step] = rows[step] = rows.get(step, 0) + draw.randint(1, 9)
        parts.append((changed, dict(rows)))
    spark.createDataFrame([], "course string, n long, window_end timestamp_ntz").write.parquet(f"{base}/boards/batch_id=-1")
    handle, minute, end = write_leaderboard(spark, base, "course", "n", compact_every=6), timedelta(minutes=1), None
    for i, (changed, known) in enumerate(parts):
        data = [(START + m * minute, START + m * minute + minute, c, n) for (m, c), n in changed.items()]
        for _ in range(2 if i % 5 == 4 else 1):
            handle(spark.createDataFrame(data, schema), i)
        end = max([m for m, _ in known], default=None)
        want = {}
        for (m, c), n in known.items():
            if end - 60 < m:
                want[c] = want.get(c, 0) + n
        assert {r.course: r.n for r in read_leaderboard(spark, base).collect()} == want, i


def test_leaderboard_reads_only_slides_that_changed(spark, tmp_path):
    """A batch looks up the slides it writes to and those that left the hour, not all steps."""
    base, schema = f"{tmp_path}/known", "window_start timestamp_ntz, window_end timestamp_ntz, course string, n long, batch_id long"
    minute = timedelta(minutes=1)
    steps = [(START + m * minute, START + m * minute + minute, f"c{k}", 1, 0) for m in range(60) for k in range(50)]
    spark.createDataFrame(steps, schema).write.parquet(base)
    known = spark.read.schema(schema).parquet(base)
    recent = spark.createDataFrame([(START + 59 * minute, START + 60 * minute, "c1", 5, 1)], schema)
    changes = step_changes(recent, known, "course", "n", START + minute, (START, START + 60 * minute))
    assert changes.count() == 1 + 1 + 50  # the new step, the one it replaces, the minute that has passed
    assert changes._jdf.queryExecution().executedPlan().toString().count("PushedFilters: [IsNotNull(window_start)") >= 2
    found = summed(known.select("course", "n", F.lit(1).cast("bigint").alias("steps")).unionByName(changes), "course", "n")
    assert {r.course: (r.n, r.steps) for r in found.collect()} == {f"c{k}": (59 + 4 * (k == 1), 59) for k in range(50)}


def test_live_level_counts(spark, files, rows, tmp_path):
    """Counts of the last two minutes up to the newest line, after every batch."""
    path = files(heartbeats((0, "WARN"), (1, "WARN"), (100, "INFO")), heartbeats((121, "WARN"), (60, "INFO")))
    query = start_level_counts(stream(spark, path), f"{tmp_path}/out", f"{tmp_path}/checkpoint", "course", "ts")
    query.awaitTermination()
    first = spark.read.parquet(f"{tmp_path}/out/boards/batch_id=0").select("course", "total")
    assert rows(first) == [("INFO", 1), ("WARN", 2)]
    last = read_leaderboard(spark, f"{tmp_path}/out").select("course", "total")
    assert rows(last) == [("INFO", 2), ("WARN", 1)]


def test_leaderboard_of_nothing_is_empty(spark, tmp_path):
    base = f"{tmp_path}/out"
    nothing = step_sums(spark.createDataFrame([], SCHEMA), "ts", "1 minute", "course", F.lit(5), "n")
    nothing.select("course", "n", "window_end").write.parquet(f"{base}/boards/batch_id=-1")
    write_leaderboard(spark, base, "course", "n")(nothing, 0)
    assert spark.read.parquet(f"{base}/boards/batch_id=0").count() == 0


def test_ranking_breaks_ties_by_key(spark):
    steps = step_sums(spark.createDataFrame(FILES[0], SCHEMA), "ts", "1 minute", "course", F.lit(5), "n")
    board = ranking(steps, "course", "n", START + timedelta(minutes=11), timedelta(hours=1), rows=3)
    assert [(r.course, r.n) for r in board.collect()] == [("a", 10), ("b", 5), ("c", 5)]


def test_console_and_interval(spark, files, tmp_path):
    sums = tumbling_sum(stream(spark, files(FILES[0])), "ts", "2 minutes", ["course"], F.lit(5), "s")
    writer = console_writer(sums, rows=50, interval="1 second")
    query = writer.option("checkpointLocation", f"{tmp_path}/checkpoint").start()
    try:
        query.processAllAvailable()
        assert query.isActive and not query.awaitTermination(1)
    finally:
        query.stop()
    assert not query.isActive
    first = query.recentProgress[0]
    assert "Console" in first.sink.description
    assert (first.numInputRows, first.sink.numOutputRows) == (4, 3)


def test_failure_in_a_batch_is_raised(spark, files, tmp_path):
    from tidemark.sources.sinks import start_batches

    def fail(batch, batch_id):
        raise ValueError("broken sink")

    query = start_batches(stream(spark, files(FILES[0])), fail, shared_folder(spark, "fail"), "append")
    with pytest.raises(Exception, match="broken sink"):
        query.awaitTermination()
