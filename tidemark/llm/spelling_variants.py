"""Spelling variants: words one edit apart, and the far more frequent word that each stands for.

Two words of m letters at most, one edit apart, share their first or their last half (m // 2 letters), so
words meet by length and half. Words that share a half are laid into matrices of code points, once
aligned at their starts and once at their ends, and blocks of them are compared densely: where common
prefix and common suffix together reach the longer length less one, the words are a single edit apart.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, slices, stored

# Fixed value: the letters of words.
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LETTERS, MIN_COUNT, TIMES = 6, 5, 5

# Most words of one half in a block; more are divided, and every pair of blocks is a tile.
BLOCK = 2048
# About so many rows in a task that compares halves, and so many different words counted before they move.
TASK_ROWS = 1 << 16
HELD_WORDS = 1 << 19
# Largest part of a tile that is compared at a time.
_TILE = 512


def damaged_runs(text: str, key: str, every: int) -> Counter:
    """Words of one text with A-Z in lower case, and how often each occurs.

    If ``every`` is not 0, a run of letters loses one where ``every`` divides the checksum of ``key:run``, which
    plants misspellings that are known.
    """
    runs = Counter(LETTERS.findall(text.encode().lower().decode()))
    if every:
        start = zlib.crc32(f"{key}:".encode())
        # all are taken out before any comes back: what a run becomes may be a run that loses a letter itself
        damaged = []
        for run in [run for run in runs if zlib.crc32(run.encode(), start) % every == 0]:
            at = zlib.crc32(run.encode(), start) % len(run)
            damaged.append((run[:at] + run[at + 1 :], runs.pop(run)))
        for run, n in damaged:
            runs[run] += n
    return runs


def count_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    damage_every: int = 0,
) -> DataFrame:
    """``word, n``: the words of ``min_letters`` letters or more that occur ``min_count`` times or more.

    ``damage_every`` as in :func:`damaged_runs`, keyed by the id. A null text has no words, a null id is an
    empty key, repeated rows count again, and without rows there are no words. Each task sums what it
    holds before words move.
    """
    key = F.coalesce(column(docs, id_col).cast("string"), F.lit(""))
    source = docs.select(key.alias("key"), column(docs, text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = [w for w in total if len(w) >= min_letters]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, type=pa.string()), pa.array([total[w] for w in words], type=pa.int64())], ["word", "n"]
            )

        for whole in batches:
            for batch in slices(whole, "text"):
                for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    if text:
                        total.update(damaged_runs(text, key, damage_every))
                if len(total) >= HELD_WORDS:
                    yield rows()
                    total.clear()
        yield rows()

    sums = source.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") >= min_count)


def matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of words, padded with zeros: aligned at their starts, at their ends, and their lengths."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    width = int(lengths.max(initial=0))
    points = np.frombuffer("".join(w.ljust(width, "\x00") for w in words).encode("utf-32-le"), dtype="<u4")
    starts = points.reshape(len(words), width)
    if starts.max(initial=0) < 256:
        starts = starts.astype(np.uint8)
    shift = np.arange(width)[None, :] - (width - lengths)[:, None]
    ends = np.where(shift >= 0, np.take_along_axis(starts, np.maximum(shift, 0), axis=1), 0)
    return starts, ends, lengths


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal columns at the start of each row of ``a`` and each of ``b``; zeros are padding and end it."""
    alive = np.ones((len(a), len(b)), dtype=bool)
    found = np.zeros((len(a), len(b)), dtype=np.uint16 if a.shape[1] < 1 << 16 else np.uint32)
    for k in range(a.shape[1]):
        alive &= (a[:, k][:, None] == b[:, k][None, :]) & (a[:, k] != 0)[:, None]
        if not alive.any():
            break
        found += alive
    return found


def single_edits(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, row of ``b``, common prefix) of all words one edit apart; both are ``matrices``."""
    out = []
    for i in range(0, len(a[2]), _TILE):
        for j in range(0, len(b[2]), _TILE):
            rows, others = slice(i, i + _TILE), slice(j, j + _TILE)
            prefix = _common(a[0][rows], b[0][others])
            suffix = _common(a[1][rows][:, ::-1], b[1][others][:, ::-1])
            most = np.maximum(a[2][rows][:, None], b[2][others][None, :])
            least = np.minimum(a[2][rows][:, None], b[2][others][None, :])
            near = (prefix + suffix.astype(np.int64) >= most - 1) & (most - least <= 1)
            near &= ~((most == least) & (prefix == most))  # the same word
            x, y = np.nonzero(near)
            out.append((x + i, y + j, prefix[x, y].astype(np.int64)))
    if not out:
        return (np.zeros(0, dtype=np.int64),) * 3
    x, y, prefix = (np.concatenate(c) for c in zip(*out, strict=True))
    return x, y, prefix


def _tile(long: int, last: bool, words: list[str], n: np.ndarray, part: np.ndarray, low: int, high: int) -> list[tuple]:
    """Per word of one tile that has near words: the word, how many, the largest count of one, and the first such.

    ``long`` is the longer length of the pairs that are looked for, ``last`` whether the words share their last half
    (pairs that share the first one, too, were found there).
    """
    starts, ends, lengths = matrices(words)
    half = long // 2
    pairs = []
    for pick, other in ([(low, low)] if low == high else [(low, high), (high, low)]):
        a = np.flatnonzero((part == pick) & (lengths == long))
        b = np.flatnonzero(part == other)
        if not len(a) or not len(b):
            continue
        x, y, prefix = single_edits((starts[a], ends[a], lengths[a]), (starts[b], ends[b], lengths[b]))
        fresh = ~(last & (prefix >= half))
        x, y = a[x[fresh]], b[y[fresh]]
        pairs.append((x, y))
        # pairs of two long words come in both orders, from both picks or from the one block itself
        short = lengths[y] < long
        pairs.append((y[short], x[short]))
    if not pairs:
        return []
    x, y = (np.concatenate(c) for c in zip(*pairs, strict=True))
    if not len(x):
        return []
    # words come in code-point order, so of equal counts the first is the smallest
    order = np.lexsort((y, -n[y], x))
    x, y = x[order], y[order]
    heads = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    sizes = np.diff(heads, append=len(x))
    return [(words[i], int(k), int(n[j]), words[j]) for i, j, k in zip(x[heads], y[heads], sizes, strict=True)]


def near_words(words: DataFrame, block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """``word, n_near, near_n, near``: for each of ``words`` (``word, n``) that has words one edit apart, how
    many, and the most frequent of them (of equal counts the first in code-point order) with its count.

    Every pair is found in one tile: where both share the first half, or else the last. A half that
    more than ``block`` words share is divided, and each of its words goes to as many tiles as there are
    blocks; no pairs leave a tile, only sums per word. Dense comparison costs the square of the words of one half,
    so halves of half the longer length, which grow with it, keep them few.
    """
    n_tasks = 1 + words.count() * 4 // task_rows
    length = F.length("word")
    kinds = []
    for long in (length, length + 1):
        half = (long / 2).cast("int")
        for last, start in ((False, F.lit(1)), (True, length - half + 1)):
            kinds.append(F.struct(long.alias("long"), F.lit(last).alias("last"), F.substring(F.col("word"), start, half).alias("half")))
    group = ["long", "last", "half"]
    keyed = words.select("word", "n", F.explode(F.array(*kinds)).alias("h")).select("word", "n", "h.*")
    large = keyed.groupBy(*group).agg(F.count("*").alias("size")).filter(F.col("size") > block)
    parts = F.coalesce(F.ceil(F.col("size") / block).cast("int"), F.lit(1))
    dealt = keyed.join(large, group, "left").withColumn("parts", parts)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("word"), "parts").cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    tiled = dealt.withColumn("other", F.explode(others)).select(
        "word", "n", *group, "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    tiled = tiled.withColumn("task", F.pmod(F.xxhash64(*group, "low", "high"), F.lit(n_tasks)))

    def compare(task: pa.Table) -> pa.Table:
        task = task.sort_by([(c, "ascending") for c in (*group, "low", "high", "word")])
        same = np.ones(max(task.num_rows - 1, 0), dtype=bool)
        for name in (*group, "low", "high"):
            codes = task[name].combine_chunks().dictionary_encode().indices.to_numpy()
            same &= codes[1:] == codes[:-1]
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        words, n, part = task["word"].to_pylist(), task["n"].to_numpy(), task["part"].to_numpy()
        long, last, low, high = (task[c].to_pylist() for c in ("long", "last", "low", "high"))
        rows = []
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), task.num_rows], strict=True):
            if j - i > 1:
                rows += _tile(long[i], last[i], words[i:j], n[i:j], part[i:j], low[i], high[i])
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.table([pa.array(list(c), type=t) for c, t in zip(columns, types, strict=True)], ["word", "k", "most", "near"])

    found = tiled.groupBy("task").applyInArrow(compare, "word string, k long, most long, near string")
    # of equal counts the first in code-point order, which is that of UTF-8
    best = F.min(F.struct((-F.col("most")).alias("less"), F.col("near")))
    sums = found.groupBy("word").agg(F.sum("k").alias("n_near"), best.alias("best"))
    return sums.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def group_spellings(words: DataFrame, times: int = TIMES, block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every one of the distinct ``words`` (``word, n``).

    ``form`` is the near word of the largest count if that is at least ``times`` the word's own, else null;
    ``root`` is where forms lead, from form to form. Every word has a row; words without near words have
    ``n_near`` 0. Null words have no row.
    """
    words = stored(words.filter(F.col("word").isNotNull()).select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(words, block, task_rows)
    is_form = F.col("near_n") >= times * F.col("n")
    found = words.join(near, "word", "left").select(
        "word",
        F.when(is_form, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    found = stored(found, "spelling-forms")
    # Each step doubles how far roots are followed. Counts grow by ``times``, so there are few steps.
    steps = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        steps = stored(steps, "spelling-roots")
        beyond = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        further = steps.join(beyond, "root")
        if further.isEmpty():
            break
        steps = steps.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
    roots = found.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return roots.select("word", "form", "root", "n", "n_near", "form_n")
