from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.session import shared_folder
from tidemark.sources import schemas
from tidemark.sources.files import read_csv, read_csv_strings, read_lines, read_table
from tidemark.sources.streams import kafka_values, log_levels, parquet_stream, socket_lines, table_stream


@pytest.fixture
def write(tmp_path):
    def save(name: str, text: str) -> str:
        (tmp_path / name).write_bytes(text.encode())
        return str(tmp_path / name)

    return save


def test_typed_csv_with_windows_line_ends(spark, write):
    path = write("t.csv", "country,rebill_period,payments_made,chapter_access_count,seconds_watched\r\n"
                          "US,1,2,3,4\r\nGB,12,0,,7\r\n")  # fmt: skip
    trials = read_csv(spark, path, schemas.FREE_TRIALS)
    assert [tuple(r) for r in trials.collect()] == [("US", 1, 2, 3, 4), ("GB", 12, 0, None, 7)]
    assert trials.schema["seconds_watched"].dataType.simpleString() == "int"


def test_csv_header_must_fit_the_schema(spark, write):
    path = write("t.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, "a int, b int").collect()


def test_csv_value_that_does_not_fit(spark, write):
    path = write("t.csv", "1,x\n2,3\n")
    lenient = read_csv(spark, path, schemas.VIEWS, header=False, strict=False)
    assert [tuple(r) for r in lenient.collect()] == [(1, None), (2, 3)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_csv(spark, path, schemas.VIEWS, header=False).collect()


def test_csv_of_strings_and_quoted_commas(spark, write):
    path = write("students.csv", 'subject,score\n"Maths, pure",A\nBiology,B\n')
    found = read_csv_strings(spark, path, ["subject", "score"])
    assert [tuple(r) for r in found.collect()] == [("Maths, pure", "A"), ("Biology", "B")]
    assert {t for _, t in found.dtypes} == {"string"}


def test_glob_of_headerless_files(spark, write, tmp_path, rows):
    write("views-1.csv", "14,96\n13,97\n")
    write("views-2.csv", "14,98\n")
    write("other.csv", "0,0\n")
    views = read_csv(spark, f"{tmp_path}/views-*.csv", schemas.VIEWS, header=False)
    assert rows(views) == [(13, 97), (14, 96), (14, 98)]
    both = read_csv(spark, [f"{tmp_path}/views-1.csv", f"{tmp_path}/other.csv"], schemas.VIEWS, header=False)
    assert both.count() == 3


def test_lines_without_header(spark, write):
    path = write("log.txt", "level,datetime\nWARN,x\nINFO,y\n")
    assert [r.value for r in read_lines(spark, path, "level,datetime").collect()] == ["WARN,x", "INFO,y"]
    assert read_lines(spark, path).count() == 3


def test_table_as_file_or_folder(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/numbers.parquet")
    assert read_table(spark, str(tmp_path), "numbers").count() == 5
    stream = table_stream(spark, str(tmp_path), "numbers", "id bigint")
    query = stream.writeStream.format("memory").queryName("numbers").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("numbers").count() == 5


def test_parquet_stream_takes_few_files_at_a_time(spark, tmp_path):
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/n")
    stream = parquet_stream(spark, f"{tmp_path}/n", "id bigint", files_per_batch=1)
    query = stream.writeStream.format("memory").queryName("n").trigger(availableNow=True).start()
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3


def test_log_lines_to_levels(spark):
    data = [
        ("WARN,Tue Mar 05 16:24:07 GMT 2019",),
        ("DEBUG,Tue Mar 05 16:24:07 CET 2019",),
        ("INFO,soon",),
        ("FATAL",),
    ]
    lines = spark.createDataFrame(data, "value string")
    arrived = lines.withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    levels = log_levels(arrived).select("level", F.col("timestamp").cast("string"))
    assert [tuple(r) for r in levels.collect()] == [
        ("WARN", "2019-03-05 16:24:07"),
        ("DEBUG", "2019-03-05 15:24:07"),
        ("INFO", "2024-01-01 00:00:00"),
        ("FATAL", "2024-01-01 00:00:00"),
    ]


def test_socket_lines_have_text_and_time(spark):
    lines = socket_lines(spark, "localhost", 8989)
    assert lines.isStreaming
    assert lines.dtypes == [("value", "string"), ("timestamp", "timestamp")]
    assert log_levels(lines).dtypes == [("level", "string"), ("timestamp", "timestamp")]


def test_kafka_needs_its_connector(spark):
    """Without the connector on the class path Spark says which source is missing."""
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_values(
            spark, "localhost:9092", ["views"], group_id="readers", max_offsets_per_batch=1000
        )


def test_shared_folder_is_below_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_inferred_types(spark, write):
    path = write("t.csv", "a,b,c\n1,x,0.5\n2,y,1\n")
    assert read_csv(spark, path, None).dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
