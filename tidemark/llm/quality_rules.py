"""Quality rules on repetition: how much of a text lies in word n-grams and lines seen before."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import WORD, column, filter_texts, mixed, slices

# Largest share of word characters in n-grams that occurred before in the text, by n.
MAX_COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
# Largest share of line characters in lines that occurred before.
MAX_LINE_COVERAGE = 0.30
MIN_WORDS = 10
WINDOW = 5
SYMBOLS = "#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, coverage array<double>, line_coverage double"
)


def _occurrences(codes: np.ndarray, hashes: np.ndarray, starts: np.ndarray, n: int):
    """Of the n-grams at ``starts``: those that occur twice or more, and those that occurred before.

    Rolling hashes find them; every pair of equal hashes is compared word by word, and if two
    different n-grams ever share a hash the text is counted exactly instead.
    """
    order = starts[np.argsort(hashes[starts], kind="stable")]
    same = hashes[order[1:]] == hashes[order[:-1]]
    before, after = order[:-1][same], order[1:][same]
    if any(not np.array_equal(codes[before + k], codes[after + k]) for k in range(n)):
        seen: dict[tuple, int] = {}
        first = np.array([seen.setdefault(tuple(codes[i : i + n]), i) for i in starts.tolist()])
        after = starts[first != starts]
        return np.union1d(first[first != starts], after), after
    return np.union1d(before, after), after


def _covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Mask of the words inside the n-grams at ``starts``."""
    steps = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(text: str | None, max_coverage: dict[int, float], max_line_coverage: float) -> tuple:
    """The rule columns of ``SCHEMA`` for one text."""
    text = text or ""
    words = WORD.findall(text)
    n_words = len(words)
    vocabulary: dict[str, int] = {}
    codes = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], dtype=np.int64)
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    word_chars = int(lengths.sum())

    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen: set[str] = set()
    again = [line for line in lines if line in seen or seen.add(line)]
    line_chars = sum(map(len, lines))
    line_coverage = sum(map(len, again)) / line_chars if line_chars else 0.0

    hashes = mixed(codes)
    terms, candidates, n_repeat_words, coverage = hashes, None, 0, {n: 0.0 for n in max_coverage}
    for n in range(2, max([WINDOW, *max_coverage]) + 1):
        if n_words < n:
            break
        hashes = hashes[:-1] * _BASE + terms[n - 1 :]
        if n < WINDOW:
            continue
        # an n-gram can only repeat where both (n - 1)-grams in it do
        starts = np.arange(n_words - n + 1) if candidates is None else candidates
        repeated, later = _occurrences(codes, hashes, starts, n)
        if n == WINDOW:
            n_repeat_words = int(_covered(repeated, n, n_words).sum())
        if n in coverage and len(later):
            coverage[n] = float(lengths[_covered(later, n, n_words)].sum() / word_chars)
        candidates = repeated[:-1][repeated[1:] == repeated[:-1] + 1]
        if not len(candidates):
            break

    base_failed = n_words < MIN_WORDS or 100 * n_repeat_words > 20 * n_words
    fine = line_coverage <= max_line_coverage and all(coverage[n] <= most for n, most in max_coverage.items())
    return (
        n_words,
        word_chars,
        sum(map(text.count, SYMBOLS)),
        len(again),
        n_repeat_words,
        base_failed,
        not base_failed and fine,
        [coverage[n] for n in sorted(coverage)],
        line_coverage,
    )


def quality_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_coverage: dict[int, float] = MAX_COVERAGE,
    max_line_coverage: float = MAX_LINE_COVERAGE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the columns of ``SCHEMA``.

    ``coverage`` holds, for each n of ``max_coverage`` ascending, the share of word characters inside
    n-grams that occurred before in the text; ``line_coverage`` that of characters in such lines. A row
    is ``kept`` unless the base rule fails or a share is above its limit. A null or empty text has no
    words and fails. Null ids and repeated rows stay as they are; other columns are not looked at.
    No row leaves its task and a task holds a few megabytes of text at a time, or one text.
    """
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    limits = dict(max_coverage)
    kind = source.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [measure(t.as_py(), limits, max_line_coverage) for t in batch.column("text")]
                columns = [pa.array(list(c)) for c in zip(*found, strict=True)]
                columns[7] = columns[7].cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns],
                    ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))],
                )

    return source.mapInArrow(rows, f"doc_id {kind}, {SCHEMA}")


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    max_coverage: dict[int, float] = MAX_COVERAGE,
    max_line_coverage: float = MAX_LINE_COVERAGE,
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``quality_report`` keeps.

    A null text has no words and goes. Only the text decides, so rows without an id and repeated rows are
    judged one by one; without rows there is none.
    """
    limits = dict(max_coverage)

    def keeper():
        return lambda texts: [measure(t.as_py(), limits, max_line_coverage)[6] for t in texts]

    return filter_texts(docs, text_col, 8 << 20, keeper)
