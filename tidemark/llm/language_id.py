"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, slices

UNKNOWN = "und"
# The model is fitted on about so many labelled rows of each language, chosen by a hash of the id.
SAMPLE_ROWS = 4000
# Languages times buckets times four bytes are broadcast, so both are bounded.
BUCKETS = 1 << 15
MAX_LANGUAGES = 500
ORDERS = (1, 2, 3)
_SEED = np.uint32(2654435761)

_SPACE = 32
_TABLE: list[np.ndarray] = []  # filled once per worker process


def _letters() -> np.ndarray:
    """Lower-case letter of each code point, a space for what is no letter."""
    if not _TABLE:
        table = np.full(0x110000, _SPACE, dtype=np.uint32)
        for code in range(0x110000):
            c = chr(code)
            if c.isalpha():
                table[code] = ord(c.lower()[0])
        _TABLE.append(table)
    return _TABLE[0]


@dataclass(frozen=True)
class Grams:
    """Hashed n-grams of a batch: bucket of each, and the text it lies in, in text order."""

    buckets: np.ndarray
    parents: np.ndarray
    has_letter: np.ndarray


def hashed_grams(texts: list[str | None], buckets: int = BUCKETS) -> Grams:
    """Buckets of all n-grams of letters, each text between two spaces; no n-gram spans two texts.

    Runs of other characters count as one space, so marks, digits and layout tell nothing.
    """
    padded = [f" {t or ''} " for t in texts]
    sizes = np.array([len(t) for t in padded])
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    chars = _letters()[codes]
    parents = np.repeat(np.arange(len(texts)), sizes)
    letter = chars != _SPACE
    has_letter = np.bincount(parents[letter], minlength=len(texts)) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a space counts after a letter only
    first = np.cumsum(sizes) - sizes
    keep[first] = True
    chars, parents = chars[keep], parents[keep]
    found, of = [], []
    for n in ORDERS:
        if len(chars) < n:
            break
        end = len(chars) - n + 1
        h = np.full(end, n, dtype=np.uint32)
        for k in range(n):
            h = (h ^ chars[k : k + end]) * _SEED
            h ^= h >> np.uint32(15)
        whole = parents[:end] == parents[n - 1 :]
        found.append((h[whole] % np.uint32(buckets)).astype(np.int64))
        of.append(parents[:end][whole])
    return Grams(np.concatenate(found), np.concatenate(of), has_letter)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages, float32


def held_out_rows(doc_id: Column) -> Column:
    """Rows that never train: the remainder of the checksum of the id's text is 2."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> Model:
    """Model of ``labelled`` (key, text, lang): n-gram counts per language over a bounded sample.

    A row of a language with n rows is taken if a hash of its key is among the lowest
    ``sample_rows`` / n of all values, so a language brings about ``sample_rows`` rows however large
    the corpus is, and only a few counts per task move.
    """
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = usable.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if not sizes:
        return Model([], np.zeros(0), np.zeros((buckets, 0), dtype=np.float32))
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; raise MAX_LANGUAGES knowingly")
    languages = [r["lang"] for r in sizes]
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(sample_rows / r["count"])).otherwise(share)
    draw = (F.shiftrightunsigned(F.xxhash64("key"), 11).cast("double")) / F.lit(float(2**53))
    sample = usable.filter(draw < share).select("lang", "text")
    rank = {lang: i for i, lang in enumerate(languages)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(rank), buckets), dtype=np.int64)
        for whole in batches:
            for batch in slices(whole, "text"):
                grams = hashed_grams(batch.column("text").to_pylist(), buckets)
                langs = np.array([rank[x] for x in batch.column("lang").to_pylist()])
                at = langs[grams.parents] * buckets + grams.buckets
                counts += np.bincount(at, minlength=counts.size).reshape(counts.shape)
        for i in np.flatnonzero(counts.any(axis=1)).tolist():
            used = np.flatnonzero(counts[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), i)), pa.array(used), pa.array(counts[i][used])],
                ["language", "bucket", "n"],
            )

    sums = sample.mapInArrow(counted, "language long, bucket long, n long").groupBy("language", "bucket")
    table = sums.agg(F.sum("n").alias("n")).toArrow()  # languages x buckets rows at most
    counts = np.ones((buckets, len(languages)))  # add-one smoothing
    counts[table["bucket"].to_numpy(), table["language"].to_numpy()] += table["n"].to_numpy()
    rows = np.array([r["count"] for r in sizes], dtype=float)
    return Model(languages, np.log(rows / rows.sum()), np.log(counts / counts.sum(axis=0)).astype(np.float32))


def scores(texts: list[str | None], model: Model) -> tuple[list[str], list[float]]:
    """Most probable language of each text, by prior and the sum over all its n-grams, and a score from 0 to 1.

    The score is the probability of the choice if a text of more than 20 n-grams had 20 of the same mean:
    overlapping n-grams are far from independent, and the probability of a long text would always be one. The
    choice is not affected.
    """
    grams = hashed_grams(texts, len(model.log_prob))
    n_grams = np.bincount(grams.parents, minlength=len(texts))
    sums = np.empty((len(texts), len(model.languages)))
    for i in range(len(model.languages)):
        weights = model.log_prob[:, i][grams.buckets]
        sums[:, i] = np.bincount(grams.parents, weights=weights, minlength=len(texts))
    posterior = sums + model.log_prior
    best = posterior.argmax(axis=1)
    posterior -= posterior.max(axis=1, keepdims=True)
    odds = np.exp(posterior * (np.minimum(n_grams, 20) / np.maximum(n_grams, 1))[:, None])
    chance = 1 / odds.sum(axis=1)  # the odds of the choice are one
    known = grams.has_letter
    langs = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    return langs, np.where(known, chance, 0.0).tolist()


def identify_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (0 to 1) of every row.

    The model learns from rows that are not held out and have a text and a language. A prediction
    sees the whole text and nothing else. ``und`` with score 0 stands for a null text, one without a
    letter, and any text if no row could be learned from. Ties go to the language that sorts first.
    A null id counts as an empty one; repeated rows each get their result; other columns are ignored.
    """
    source = docs.select(
        column(docs, id_col).alias("doc_id"),
        column(docs, text_col).alias("text"),
        column(docs, lang_col).cast("string").alias("lang"),
    ).withColumn("held_out", held_out_rows(F.col("doc_id")))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    model = fit(source.filter(~F.col("held_out")).withColumn("key", key), sample_rows, buckets)
    kind = source.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                n = batch.num_rows
                langs, chance = [UNKNOWN] * n, [0.0] * n
                if shared.value.languages:
                    langs, chance = scores(batch.column("text").to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(langs), pa.array(chance)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    return source.drop("lang").mapInArrow(
        rows, f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    )
