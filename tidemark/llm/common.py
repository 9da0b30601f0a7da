"""What several operators here share: written tables, column checks, and words of Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import shared_folder

# Everything but a space, tab, line feed, vertical tab, form feed and carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    This cuts the lineage: later jobs, and tasks that are repeated after an executor is lost, read the
    files. The folder belongs to the run and may be removed once the results are used.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(df: DataFrame, name: str) -> Column:
    """Column ``name`` whatever characters its name has."""
    return df["`" + name.replace("`", "``") + "`"]


def with_row_ids(df: DataFrame) -> DataFrame:
    """``df`` with a number ``rid`` for each row; fixed only once the result is ``stored``."""
    return df.withColumn("rid", F.monotonically_increasing_id())


def batch_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of a batch of texts: number of words per text, code of each word, and the words by code.

    A null text has no words.
    """
    pieces = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    values, parents = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    real = pc.greater(pc.binary_length(values), 0)
    values, parents = values.filter(real), parents.filter(real)
    coded = values.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    counts = np.bincount(parents.to_numpy(zero_copy_only=False), minlength=len(texts))
    return counts, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers from others, one to one (two rounds of xor-shift and multiply)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def filter_texts(docs: DataFrame, text_col: str, limit: int, keeper: Callable) -> DataFrame:
    """The rows of ``docs``, all columns, that pass: ``keeper`` is called once per task and gives a
    function from an array of texts to a list of decisions. Columns are numbered meanwhile, since
    names may hold dots."""
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index(text_col)}"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = keeper()
        for whole in batches:
            for batch in slices(whole, text, limit):
                yield batch.filter(pa.array(decide(batch.column(text)), type=pa.bool_()))

    return numbered.mapInArrow(rows, numbered.schema).toDF(*docs.columns)


def slices(batch: pa.RecordBatch, text: str, limit: int = 8 << 20):
    """Parts of a batch with at most ``limit`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)
