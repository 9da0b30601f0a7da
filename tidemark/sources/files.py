"""Batch sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, StringType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | StructType | None,
    header: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Delimited files as typed columns; ``path`` may be a glob or a list.

    The schema follows the file's column order and is checked against its header. A value that
    does not fit its type raises, or becomes null if not ``strict``. Quoted commas are kept. Without
    a schema Spark infers the types, which reads the files once more.
    """
    reader = spark.read.option("header", header).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", not header).csv(path)


def read_csv_strings(
    spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None
) -> DataFrame:
    """Delimited files with a header, every column a string; the header names them if you do not."""
    if columns is None:
        return spark.read.option("header", True).csv(path)
    schema = StructType([StructField(name, StringType()) for name in columns])
    return read_csv(spark, path, schema)


def read_lines(spark: SparkSession, path: str | list[str], header_prefix: str | None = None) -> DataFrame:
    """Text files as one ``value`` column, without lines that begin with ``header_prefix``."""
    lines = spark.read.text(path)
    if header_prefix is None:
        return lines
    return lines.filter(~lines["value"].startswith(header_prefix))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` (a file or a folder of files) below ``folder``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in ``folder``, in any file system that Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(path)]


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove ``folder`` and all in it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """What a small text file holds, or None if there is no such file."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(name):
        return None
    stream = files.open(name)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file in place of the one before in one step, so that readers find either."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    name, fresh = hadoop.Path(path), hadoop.Path(f"{path}.fresh")
    stream = name.getFileSystem(spark._jsc.hadoopConfiguration()).create(fresh, True)
    stream.write(text.encode())
    stream.close()
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    files = hadoop.FileContext.getFileContext(name.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(fresh, name, overwrite)
