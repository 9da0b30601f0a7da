from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling_variants
from tidemark.llm.spelling_variants import count_words, damaged_runs, group_spellings, matrices, single_edits


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain(counts, times=5):
    """All words against all."""
    out = {}
    for word, n in counts.items():
        near = sorted((w for w in counts if one_edit(word, w)), key=lambda w: (-counts[w], w))
        form = near[0] if near and counts[near[0]] >= times * n else None
        out[word] = (form, n, len(near), counts[form] if form else None)
    rows = []
    for word, (form, *rest) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        rows.append((word, form, root, *rest))
    return sorted(rows)


def drawn(seed, n, letters="abé", size=8):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(4, size))) for _ in range(n)}
    return {w: 5 ** draw.randint(0, 5) + draw.randint(0, 3) for w in sorted(words)}


def test_single_edits_against_definition():
    words = sorted(drawn(1, 150))
    whole = matrices(words)
    x, y, _ = single_edits(whole, whole)
    found = {(words[i], words[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)} and len(found) == len(x)


@pytest.mark.parametrize("block, task_rows", [(2048, 1 << 16), (7, 50), (1, 1)])
def test_groups_against_all_pairs(spark, block, task_rows):
    counts = drawn(2, 250 if block > 1 else 80)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = sorted(tuple(r) for r in group_spellings(words, block=block, task_rows=task_rows).collect())
    assert found == plain(counts)
    assert len({r[2] for r in found}) < len(found) and any(r[1] and r[1] != r[2] for r in found)


def test_wide_letters(spark):
    counts = {"日本語日本語": 50, "日本語日本誤": 5, "😀😀😀😀😀😀": 9, "😀😀😀😀😀": 3, "abcdef": 30, "abdef": 6}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in group_spellings(words).collect()) == plain(counts)


def test_counts_of_documents(spark, documents, monkeypatch):
    monkeypatch.setattr(spelling_variants, "HELD_WORDS", 100)  # words move many times
    want = Counter()
    for r in documents.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            want[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
    assert {r["word"]: r["n"] for r in count_words(documents, damage_every=199).collect()} == want


def test_each_run_is_damaged_once(spark):
    def cut(run):
        h = zlib.crc32(f"1:{run}".encode())
        return run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]

    draw = random.Random(5)
    while True:  # a run that becomes another one that is damaged, too
        first = "".join(draw.choices("abcdefghij", k=10))
        if cut(cut(first)) != cut(first) != first:
            break
    text = f"{first} {cut(first)} " * 3
    assert damaged_runs(text, "1", 199) == {cut(first): 3, cut(cut(first)): 3}
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert {tuple(r) for r in count_words(docs, damage_every=199).collect()} == {(cut(first), 6), (cut(cut(first)), 6)}


def test_words_longer_than_two_bytes_count():
    words = ["a" * 65537, "a" * 65538, "a" * 65537 + "b"]
    whole = matrices(words)
    x, y, _ = single_edits(whole, whole)
    assert {(i, j) for i, j in zip(x.tolist(), y.tolist(), strict=True)} == {(0, 1), (1, 0), (0, 2), (2, 0), (1, 2), (2, 1)}


def test_odd_rows(spark, odd_rows, no_rows):
    words = count_words(odd_rows, min_letters=5, min_count=2)
    counts = {r["word"]: r["n"] for r in words.collect()}
    found = group_spellings(words)
    assert sorted(tuple(r) for r in found.collect()) == plain(counts) and counts
    assert group_spellings(count_words(no_rows)).count() == 0
    words = spark.createDataFrame([(None, 7), ("", 3), ("ä", 20)], "word string, n long")
    assert sorted(tuple(r) for r in group_spellings(words).collect()) == [("", "ä", "ä", 3, 1, 20), ("ä", None, "ä", 20, 1, None)]
