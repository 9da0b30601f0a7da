from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate
from tidemark.llm.decontaminate import drop_leaks, find_leaks


def grams(text):
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])


def plain(texts, items):
    """All windows of all texts against all items that share a shingle with them."""
    out = []
    for text in texts:
        shingles, found = grams(text), []
        for number, item in items:
            want = Counter(grams(item))
            n = sum(want.values())
            at = [i for i, g in enumerate(shingles) if g in want]
            for start in range(max(0, min(at, default=0) - n), max(at, default=-1) + 1):
                window = Counter(shingles[start : start + n])
                if sum((window & want).values()) >= 0.8 * sum((window | want).values()):
                    found.append(number)
                    break
        out.append(sorted(found))
    return out


def test_all_documents_against_all_windows(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    rows = documents.collect()
    want = dict(zip([r["doc_id"] for r in rows], plain([r["text"] for r in rows], items), strict=True))
    found = {r["doc_id"]: r["items"] for r in find_leaks(documents, benchmark).collect()}
    assert found == want and any(want.values())
    kept = {r["doc_id"] for r in drop_leaks(documents, benchmark).collect()}
    assert kept == {i for i, found in want.items() if not found}


def test_copies_in_every_phase(spark):
    item = " ".join(f"item{i}" for i in range(60))
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(k)) + " " + item + " tail") for k in range(70)]
    benchmark = spark.createDataFrame([(5, item), (6, "Short one"), (7, None), (None, "x y z")], "item_id long, text string")
    docs = spark.createDataFrame([*rows, (100, "a short ONE"), (101, "Short one")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in find_leaks(docs, benchmark).collect()}
    assert all(found[k]["items"] == [5] and found[k]["first_start"] == k and found[k]["best"] == 1.0 for k in range(70))
    assert found[100]["items"] == [] and found[101]["items"] == [6]


def test_index_is_small_and_finds_all_within_the_radius():
    """At most two kilobytes of windows for an item of 60 words, beside near values of a bounded size."""
    draw = random.Random(11)
    items = [(i, " ".join(f"w{draw.randrange(5000)}" for _ in range(60))) for i in range(300)]
    _, indexes = decontaminate.build_index(items)
    windows = sum(x.nbytes for i in indexes for x in (i.prints, i.item, i.offset, *i.entry))
    assert windows <= 2048 * len(items)
    assert all(n.nbytes <= 137 * 2 << 16 for i in indexes for n in i.near)
    for index in indexes:
        flips = np.array([sum(1 << k for k in draw.sample(range(64), draw.randint(0, 14))) for _ in index.prints], dtype=np.uint64)
        prints = (index.prints ^ flips)[:: max(1, len(flips) // 400)]
        got = set(zip(*(x.tolist() for x in decontaminate._candidates(prints, index, 11)), strict=True))
        away = np.bitwise_count(prints[:, None] ^ index.prints[None, :])
        assert got == {(int(a), int(b)) for a, b in np.argwhere(away <= 11)} and got


def test_a_large_benchmark_is_refused(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 2)
    with pytest.raises(ValueError, match="too large"):
        find_leaks(documents, spark.range(3).select(F.col("id").alias("item_id"), F.lit("t").alias("text")))


def test_odd_rows(spark, odd_rows, no_rows):
    items = spark.createDataFrame([(1, "the same row twice over, with more than ten words in it, as")], "item_id long, text string")
    assert find_leaks(odd_rows, items).count() == odd_rows.count()
    kept = drop_leaks(odd_rows, items)
    assert kept.columns == odd_rows.columns and kept.count() == odd_rows.count() - 2
    nothing = no_rows.selectExpr("doc_id AS item_id", "text")
    assert drop_leaks(odd_rows, nothing).count() == odd_rows.count()
    assert find_leaks(no_rows, items).count() == drop_leaks(no_rows, items).count() == 0


def leaks(items, texts):
    match = decontaminate.Matcher(list(enumerate(items)), 0.8, decontaminate.RADIUS)
    return [sorted(f) for f in match(pa.array(texts, type=pa.string()))]


def test_cut_items_of_every_length():
    for n in range(5, 75):
        item = [f"item{i}" for i in range(n)]
        lead, tail = [f"lead{i}" for i in range(n % 13 + 3)], [f"tail{i}" for i in range(n % 7 + 3)]
        texts = []
        for k in range(max(5, n - n // 5 - 2), n + 1):
            texts += [item[:k], item[n - k :], lead + item[:k], item[n - k :] + tail, item[(n - k) // 2 :][:k]]
        texts = [" ".join(t) for t in texts]
        want = plain(texts, [(0, " ".join(item))])
        assert leaks([" ".join(item)], texts) == want and want.count([0]) >= 5


def test_edited_items():
    draw = random.Random(3)
    for n in [*range(36, 64), 80, 95, 120, 200]:
        item = [f"item{i}" for i in range(n)]
        texts = []
        for k in range(24):
            copy = list(item)
            for e in range(1 + (n > 100)):
                at = draw.randrange(len(copy)) if k > 2 else len(copy) // 2
                copy[at : at + 1] = [[f"new{e}"], [], [copy[at], f"more{e}"]][k % 3]
            texts.append(" ".join([*(f"lead{i}" for i in range(k)), *copy, *(f"tail{i}" for i in range(9))]))
        want = plain(texts, [(0, " ".join(item))])
        assert leaks([" ".join(item)], texts) == want
        assert n < 50 or want.count([0]) > 12
