from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import suffix_dedup
from tidemark.llm.suffix_dedup import common_prefixes, remove_repeats, suffix_array


def plain(rows):
    first = {}
    for number, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - 49) if number is not None else ():
            first[data[i : i + 50]] = min(first.get(data[i : i + 50], number), number)
    out = []
    for number, text in rows:
        data = (text or "").encode()
        mask = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 49) if number is not None else ():
            if first[data[i : i + 50]] < number:
                mask[i : i + 50] = True
        kept = bytes(b for b, m in zip(data, mask, strict=True) if not m)
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((number, len(data), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = remove_repeats(df).drop("kept").collect()
    return sorted((tuple(r) for r in rows), key=str)


def texts():
    draw = random.Random(1)

    def words(n):
        return " ".join("".join(draw.choices("abé", k=draw.randint(1, 6))) for _ in range(n))

    base, rows = [words(40) for _ in range(6)], []
    for i in range(150):
        text, kind = draw.choice(base), draw.random()
        if kind < 0.3:
            at = draw.randint(0, 100)
            text = text[:at] + draw.choice("xyz") + text[at:]
        elif kind < 0.5:
            text = words(20) + text[30:110] + words(10)
        elif kind < 0.6:
            text = "ab" * draw.randint(0, 80)
        rows.append((draw.choice([None, i, i, i, i, i % 50]), text))
    lengths = [(300, None), (301, ""), (302, "x" * 49), (303, "x" * 50), (304, "x" * 51), (305, "x" * 900)]
    return rows + lengths


@pytest.mark.parametrize("sizes", [(4 << 20, 16 << 20, 1 << 20), (1 << 12, 1 << 10, 64)])
def test_against_all_strings(spark, monkeypatch, sizes):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", sizes[1])
    monkeypatch.setattr(suffix_dedup, "BUCKET_ANCHORS", sizes[2])
    rows = texts()
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain(rows)


def test_all_documents_against_all_strings(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = plain(rows)
    assert found(documents) == want and sum(r[2] for r in want) > 0


def test_texts_of_nearly_equal_checksums(spark):
    """Two texts of one passage whose checksums start with the same three bytes."""
    passage, seen = "p" + "assage " * 4 + "that two texts share, of eighty bytes or so, to be found in both", {}
    for i in range(100_000):
        text = f"{i} {passage}"
        other = seen.setdefault(xxhash.xxh128_digest(text.encode())[:3], text)
        if other != text:
            break
    rows = [(1, other), (2, text)]
    got = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == plain(rows) and sum(r[2] for r in got) >= len(passage)


def test_suffix_array_and_prefixes():
    draw = random.Random(4)
    for text in ["a" * 200, "ab" * 60, "".join(draw.choices("ab", k=300)), "x", ""]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        order = suffix_array(data)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        starts = np.arange(0, len(text), 7)
        shared = common_prefixes(data, order, starts)
        for a, b in zip(order.tolist(), order.tolist()[1:], strict=False):
            n = next((k for k in range(50) if text[a + k : a + k + 1] != text[b + k : b + k + 1] or b + k >= len(text)), 50)
            assert shared[b] == min(n, len(text) - a, len(text) - b)


def test_odd_rows(odd_rows, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in odd_rows.collect()]
    assert found(odd_rows) == plain(rows)
    assert remove_repeats(no_rows).count() == 0


def test_texts_that_end_in_zero_bytes(spark):
    """Bytes of value zero are not the end of the data: such strings are told apart, and the search ends."""
    passage = "a passage that two texts have in common and that ends here" + "\0" * 60
    rows = [(1, passage), (2, "x" + passage), (3, "\0" * 70), (4, passage[:-3])]
    got = found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert got == plain(rows) and sum(r[2] for r in got) > 150


def test_holders_of_the_places_where_strings_start(monkeypatch):
    """Only places with 50 bytes of their context are ordered, and no further than a string goes."""
    sorted_rows, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **b: sorted_rows.append(len(x)) or sort(x, *a, **b))
    draw = random.Random(8)
    base = "".join(draw.choices("abcdefgh", k=400)).encode()
    contexts = [base[i : i + 60] + b"%03d" % i for i in range(0, 300, 3)] + [b"\0" * 50, b"\0" * 52]
    held = suffix_dedup.smallest_holders(contexts, np.arange(len(contexts))[::-1])
    first = {}
    for k, c in enumerate(contexts):
        for i in range(len(c) - 49):
            first[c[i : i + 50]] = len(contexts) - 1 - k
    assert [h.tolist() for h in held] == [[first[c[i : i + 50]] for i in range(len(c) - 49)] for c in contexts]
    assert len(sorted_rows) <= 8 and max(sorted_rows[1:]) < sorted_rows[0] / 3


def test_sparse_suffix_array():
    draw = random.Random(6)
    for text in ["a" * 300, "ab" * 160, "".join(draw.choices("ab", k=300)), "".join(draw.choices("abcdefgh\0", k=300))]:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        for depth in (8, 13, 50):
            places = np.array(sorted(draw.sample(range(len(data) - depth + 1), 150)))
            order = suffix_dedup.sparse_suffix_array(data, places, depth)
            strings = [text[i : i + depth] for i in order.tolist()]
            assert sorted(order.tolist()) == places.tolist() and strings == sorted(strings)
    none = np.zeros(0, dtype=np.int64)
    assert suffix_dedup.sparse_suffix_array(data, none).tolist() == []
