"""Feature preparation: indexes, one-hot vectors, assembled vectors, a repeatable split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    IndexToString,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup
from tidemark.operators.ranks import with_rank

# Categories are held on the driver and in every model; vectors are as wide as their number.
MOST_CATEGORIES = 100_000


def string_indexer(columns: Sequence[str], suffix: str = "_index", unseen: str = "keep") -> StringIndexer:
    """Estimator of category indexes by falling frequency, ties in alphabetical order.

    One job counts the categories of all columns and brings them to the driver, so call
    :func:`check_categories` first unless the values are few by nature.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[c + suffix for c in columns],
        handleInvalid=unseen,
        stringOrderType="frequencyDesc",
    )


def check_categories(df: DataFrame, columns: Sequence[str], most: int = MOST_CATEGORIES) -> None:
    """Raise if a column has clearly more than ``most`` categories, before they reach the driver.

    The numbers are estimates within about five percent, for all columns in one pass.
    """
    if not columns:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    many = {c: counts[c] for c in columns if counts[c] > most}
    if many:
        raise ValueError(f"more than {most} categories: {many}")


def category_table(df: DataFrame, column: str, index: str) -> DataFrame:
    """``column, index``: the distinct values by falling frequency, ties in alphabetical order, from 0.0.

    The same numbers as those of :func:`string_indexer`, as a table of any length: categories are
    counted by key and ranked over a range partition, and none reaches the driver. Null is no category.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    ranked = with_rank(counts, F.desc("_rows"), F.asc(column), name="_rank")
    return ranked.select(column, F.col("_rank").cast("double").alias(index))


def index_categories(
    df: DataFrame, table: DataFrame, column: str, index: str, unseen: str = "keep"
) -> DataFrame:
    """``df`` with the ``index`` of each value from a :func:`category_table`.

    Values that are not in it get the next number (``keep``), or their rows go (``skip``).
    """
    found = lookup(df, table, column, "left" if unseen == "keep" else "inner")
    if unseen != "keep":
        return found
    return found.withColumn(index, F.coalesce(F.col(index), F.lit(float(table.count()))))


def index_to_string(model: StringIndexerModel, column: str, output: str) -> Transformer:
    """Transformer from an index column of ``model`` back to its categories."""
    position = model.getOutputCols().index(column)
    return IndexToString(inputCol=column, outputCol=output, labels=model.labelsArray[position])


def one_hot_encoder(
    columns: Sequence[str], suffix: str = "_vector", unseen: str = "keep", strip: str = "_index"
) -> OneHotEncoder:
    """Estimator of one-hot vectors without the last category."""
    return OneHotEncoder(
        inputCols=list(columns),
        outputCols=[c.removesuffix(strip) + suffix for c in columns],
        handleInvalid=unseen,
        dropLast=True,
    )


def assembler(columns: Sequence[str], output: str = "features", unseen: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=unseen)


def feature_stages(numeric: Sequence[str], categorical: Sequence[str], unseen: str = "keep") -> list:
    """Pipeline stages that turn the columns into one ``features`` vector, numeric ones first."""
    if not categorical:
        return [assembler(numeric)]
    indexer = string_indexer(categorical, unseen=unseen)
    encoder = one_hot_encoder(indexer.getOutputCols(), unseen=unseen)
    return [indexer, encoder, assembler([*numeric, *encoder.getOutputCols()])]


def hash_bucket(key: Column, buckets: int = 10, digits: int = 0) -> Column:
    """Bucket of a key from its MD5 digest, the same on every run, cluster and engine.

    ``digits`` chooses one of four independent eight-digit parts of the digest, for splits of splits.
    """
    digest = F.substring(F.md5(key.cast("string")), 1 + 8 * digits, 8)
    return F.conv(digest, 16, 10).cast("bigint") % buckets


def with_row_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """``df`` with a hash of the whole row to split by, where rows have no key of their own.

    Copies of a row then fall into the same part.
    """
    return df.withColumn(name, F.xxhash64(*df.columns))


def in_first_part(key: str, tenths: int = 8, digits: int = 0) -> Column:
    return F.coalesce(hash_bucket(F.col(key), digits=digits) < tenths, F.lit(False))


def hash_split(df: DataFrame, key: str, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Two parts of ``df`` by key, about ``tenths`` tenths and the rest.

    Unlike ``randomSplit`` a row stays in its part when tasks are repeated or files rearranged.
    Rows without a key go to the second part.
    """
    first = in_first_part(key, tenths)
    return df.where(first), df.where(~first)
