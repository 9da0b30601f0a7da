"""Secret scans: candidates in each text, judged by how many owners in the whole corpus hold them."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, slices, stored, with_row_ids

# The three base patterns, in the order that breaks ties of a start.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "rare")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

# A long mixed run that no base pattern holds is a candidate, too: random, or nearly, by its letters.
RARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MIN_ENTROPY = 4.0

# A value in so many owners and so many repositories is a copied example, not someone's credential.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 3

_HEX_RUN = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)  # a run is maximal, so shorter ones can be passed over
_SCAN = (
    "rid long, doc_id {kind}, owner string, repo string, text_key string, n_assign long, n_access long, "
    "n_hex long, base_sha256 string, found array<struct<kind:string,start:int,stop:int,value:string>>"
)


def _entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base patterns and of rare-looking runs outside them."""
    found = [("assign", m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_VALUE]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m[0]) for m in _HEX_RUN.finditer(text)]
    base = list(found)
    for m in RARE.finditer(text):
        value = m[0]
        if (
            any(c.isdigit() for c in value)
            and any(c.isalpha() for c in value)
            and not any(start < m.end() and m.start() < end for _, start, end, _ in base)
            and _entropy(value) >= MIN_ENTROPY
        ):
            found.append(("rare", m.start(), m.end(), value))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0])))


def joined(found: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in found)


def _scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per row of ``docs`` with its candidates; values as hashes only, never in the clear."""
    source = docs.select(
        column(docs, id_col).alias("doc_id"),
        column(docs, text_col).alias("text"),
        column(docs, owner_col).cast("string").alias("owner"),
        column(docs, repo_col).cast("string").alias("repo"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    keyed = with_row_ids(source.withColumn("text_key", F.md5(F.coalesce("text", F.lit("")))))
    struct = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                counts, digests, lists = [], [], []
                for text in batch.column("text"):
                    found = candidates(text.as_py() or "")
                    base = [f for f in found if f[0] != "rare"]
                    kinds = Counter(f[0] for f in base)
                    counts.append([kinds["assign"], kinds["access"], kinds["hex"]])
                    digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    lists.append(
                        [
                            {"kind": k, "start": a, "stop": b, "value": hashlib.sha256(v.encode()).hexdigest()[:32]}
                            for k, a, b, v in found
                        ]
                    )
                columns = [pa.array([c[i] for c in counts], type=pa.int64()) for i in range(3)]
                columns += [pa.array(digests, type=pa.string()), pa.array(lists, type=pa.list_(struct))]
                names = ["rid", "doc_id", "owner", "repo", "text_key"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), *columns],
                    [*names, "n_assign", "n_access", "n_hex", "base_sha256", "found"],
                )

    return stored(keyed.mapInArrow(rows, _SCAN.format(kind=kind)), "secrets-scan")


def _judged(scan: DataFrame, example_owners: int, example_repos: int) -> DataFrame:
    """Per row with candidates (``rid``): all spans in order, and the numbers of live and copied ones."""
    each = scan.select("rid", "owner", "repo", F.posexplode("found").alias("place", "f")).select(
        "rid", "owner", "repo", "place", "f.*"
    )
    # Distinct holders first: a value in a third of all rows is combined in each task before it moves.
    holders = each.groupBy("value", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = holders.groupBy("value", "owner").agg(F.count("*").alias("repos"))
    spread = per_owner.groupBy("value").agg(
        F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos")
    )
    copied = spread.filter((F.col("n_owners") >= example_owners) & (F.col("n_repos") >= example_repos))
    marked = each.join(copied.select("value", F.lit(True).alias("copied")), "value", "left")
    marked = marked.withColumn("live", F.coalesce(~F.col("copied"), F.lit(True)))
    # rare-looking runs count only where they belong to few owners
    marked = marked.filter((F.col("kind") != "rare") | F.col("live"))
    spans = F.array_sort(F.collect_list(F.struct("place", "kind", "start", "stop", "live")))
    return marked.groupBy("rid").agg(spans.alias("spans"))


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """Secrets of every row, with the corpus-wide verdict on each.

    Columns: ``doc_id``, ``text_key`` (MD5 of the text), ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``spans`` (``kind:start:end`` in code points, comma-joined), ``n_live``,
    ``n_copied``, ``found`` (array of kind, start, stop, live). A value is a copied example if at least
    ``example_owners`` owners in ``example_repos`` repositories hold it, else live. Base candidates are
    reported either way, rare-looking runs only if live. A null text is empty; null owners and
    repositories count as one of that name; null ids and repeated rows each keep their own row.
    """
    scan = _scan(docs, id_col, text_col, owner_col, repo_col)
    judged = _judged(scan, example_owners, example_repos)
    spans = F.coalesce("spans", F.array().cast(judged.schema["spans"].dataType))
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    live = F.size(F.filter(spans, lambda s: s["live"])).cast("long")
    return scan.join(judged, "rid", "left").select(
        "doc_id",
        "text_key",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        F.array_join(text, ",").alias("spans"),
        live.alias("n_live"),
        (F.size(spans).cast("long") - live).alias("n_copied"),
        spans.alias("found"),
    )


def redact_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_col: str = "doc_id",
    mark: str = "[SECRET]",
    **limits: int,
) -> DataFrame:
    """``docs``, all columns and rows, with each live secret in the text replaced by ``mark``.

    Overlapping spans are replaced together. Copied examples and null texts stay; rows without an id and
    repeated rows are treated like others and stay one row each; without rows there is none.
    """
    found = find_secrets(docs, id_col, text_col, owner_col, repo_col, **limits)
    spans = found.filter("n_live > 0").select(
        F.col("doc_id").alias("found_id"),
        F.col("text_key").alias("found_key"),
        F.filter("found", lambda s: s["live"]).alias("found_spans"),
    )
    spans = spans.dropDuplicates(["found_id", "found_key"])
    # columns are numbered meanwhile, since their names may be those of the helper columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    number, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    same = number.eqNullSafe(F.col("found_id")) & (F.md5(F.coalesce(text, F.lit(""))) == F.col("found_key"))
    both = numbered.join(spans, same, "left")
    # (end of the last span, text so far); spans come by start
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done, span):
        fresh = span["start"] >= done["at"]
        kept = F.when(fresh, F.concat(F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.lit(mark)))
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.concat(done["out"], F.coalesce(kept, F.lit(""))).alias("out"),
        )

    cut = F.aggregate("found_spans", start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    clean = F.when(F.col("found_spans").isNull(), text).otherwise(cut)
    place = f"c{docs.columns.index(text_col)}"
    return both.select(*[clean.alias(c) if c == place else c for c in numbered.columns]).toDF(*docs.columns)
