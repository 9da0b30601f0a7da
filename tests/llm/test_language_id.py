from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm.language_id import fit, hashed_grams, identify_languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (both["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both["doc_id"]]).all()
    out = both[both["held_out"]]
    assert len(out) > 200 and (out["lang"] == out["lang_pred"]).mean() > 0.97
    assert both["score"].between(0, 1).all()


def plain_grams(text, buckets):
    """Buckets of the 1- to 3-grams of one text, letter by letter."""
    chars = [" "]
    for c in text or "":
        c = c.lower()[0] if c.isalpha() else " "
        if c != " " or chars[-1] != " ":
            chars.append(c)
    if chars[-1] != " ":
        chars.append(" ")
    out = []
    for n in (1, 2, 3):
        for i in range(len(chars) - n + 1):
            h = n
            for c in chars[i : i + n]:
                h = (h ^ ord(c)) * 2654435761 % 2**32
                h ^= h >> 15
            out.append(h % buckets)
    return out


@pytest.mark.parametrize("buckets", [1 << 15, 64])
def test_every_row_against_plain_naive_bayes(spark, buckets):
    """Choice and score of all rows, by counts in dictionaries; one language is rare, so the prior counts."""
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs += [(900_000 + i, t, "xx" if i % 9 else "en") for i, t in enumerate(["der the", "", None, "le la", "Ünd", "1 2"] * 3)]
    counts, rows = defaultdict(Counter), Counter()
    for number, text, lang in docs:
        if zlib.crc32(str(number).encode()) % 4 != 2 and text is not None:
            rows[lang] += 1
            counts[lang].update(plain_grams(text, buckets))
    found = identify_languages(spark.createDataFrame(docs, "doc_id long, text string, lang string"), buckets=buckets)
    found = {r["doc_id"]: r for r in found.collect()}
    total = {lang: sum(c.values()) + buckets for lang, c in counts.items()}
    for number, text, _ in docs:
        if not any(c.isalpha() for c in text or ""):
            assert (found[number]["lang_pred"], found[number]["score"]) == ("und", 0.0)
            continue
        grams = plain_grams(text, buckets)
        log = {
            lang: math.log(rows[lang] / sum(rows.values())) + sum(math.log((c[g] + 1) / total[lang]) for g in grams)
            for lang, c in counts.items()
        }
        best = max(sorted(log), key=log.get)
        assert found[number]["lang_pred"] == best
        cool = min(len(grams), 20) / len(grams)
        chance = 1 / sum(math.exp((v - log[best]) * cool) for v in log.values())
        assert math.isclose(found[number]["score"], chance, abs_tol=1e-5)


def test_predictions_do_not_see_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = "crc32(cast(doc_id AS string)) % 4 = 2"
    other = docs.selectExpr("doc_id", "text", f"if({held}, 'xx', lang) AS lang")
    a, b = identify_languages(docs), identify_languages(other)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_sample_is_bounded(spark):
    rows = [(str(i), "abc" if i % 2 else "xyz", "a" if i % 2 else "b") for i in range(4000)]
    model = fit(spark.createDataFrame(rows, "key string, text string, lang string"), sample_rows=50)
    assert model.languages == ["a", "b"]


def test_grams_stay_within_a_text():
    whole, apart = hashed_grams(["ab", "cd"]), [hashed_grams([t]) for t in ("ab", "cd")]
    for i, one in enumerate(apart):
        assert sorted(whole.buckets[whole.parents == i]) == sorted(one.buckets)


def test_odd_rows(odd_rows, no_rows):
    found = identify_languages(odd_rows)
    assert found.count() == odd_rows.count()
    und = found.filter("lang_pred = 'und'").collect()
    assert len(und) == 4 and {r["score"] for r in und} == {0.0}
    assert identify_languages(no_rows).count() == 0
    # nothing to learn from
    unlabelled = odd_rows.selectExpr("doc_id", "text", "cast(NULL AS string) AS lang")
    assert {r["lang_pred"] for r in identify_languages(unlabelled).collect()} == {"und"}
