from __future__ import annotations

import random
import re

from tidemark.llm import quality_rules
from tidemark.llm.quality_rules import MAX_COVERAGE, MAX_LINE_COVERAGE, keep_good, measure, quality_report


def plain(text):
    """Repeated words and later coverage by dictionaries."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = {}
    for n in (5, 6, 7, 8, 9, 10):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        first, repeated, later = {}, set(), set()
        for i, g in enumerate(grams):
            if g in first:
                repeated |= set(range(first[g], first[g] + n)) | set(range(i, i + n))
                later |= set(range(i, i + n))
            first.setdefault(g, i)
        out[n] = (len(repeated), sum(len(words[i]) for i in later) / max(1, sum(map(len, words))))
    return out


def test_measure_against_dictionaries():
    draw = random.Random(2)
    for _ in range(200):
        text = " ".join(draw.choice("a bb ccc dd e".split()) for _ in range(draw.randint(0, 80)))
        want = plain(text)
        got = measure(text, MAX_COVERAGE, MAX_LINE_COVERAGE)
        assert got[4] == want[5][0]
        assert all(abs(c - want[n][1]) < 1e-12 for n, c in zip(range(5, 11), got[7], strict=True))


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(quality_rules, "mixed", lambda x: (x * 0).astype("uint64"))
    text = " ".join("abcdefghijklmnop") + " a b c d e f"
    assert measure(text, MAX_COVERAGE, MAX_LINE_COVERAGE)[4] == plain(text)[5][0] == 12


def test_rules(spark):
    rows = [
        (1, "one two three four five six seven eight nine ten"),
        (2, "too short"),
        (3, "a b c d e " * 4),
        (4, "one line of words\n" * 2 + "and another line that nobody has ever seen before # $"),
    ]
    found = {r["doc_id"]: r for r in quality_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[i]["base_failed"] for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert (found[4]["n_dup_lines"], found[4]["n_symbols"]) == (1, 2)
    assert found[1]["kept"] and not found[3]["kept"]


def test_odd_rows(odd_rows, no_rows):
    found = quality_report(odd_rows)
    assert found.count() == odd_rows.count()
    kept = keep_good(odd_rows)
    assert kept.columns == odd_rows.columns
    assert kept.count() == found.filter("kept").count() > 0
    assert found.filter("doc_id IS NULL AND n_words = 0 AND NOT kept").count() == 1
    assert quality_report(no_rows).count() == keep_good(no_rows).count() == 0
