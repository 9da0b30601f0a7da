"""License scans: MinHash bands of overlapping windows find templates, exact containment confirms them.

A template belongs to the largest window size that a copy of it must hold whole, whatever the phase
of the windows in the text: its own windows are indexed at every offset. An unchanged window then
agrees in every band, one with Jaccard similarity s in at least one band with probability
1 - (1 - s) ** BANDS (0.998 at 0.8), and a changed template keeps many windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import column

SHINGLE = 5
BANDS = 4
CONTAINMENT = 0.8
# Window sizes in shingles, each with the step between the windows of a text.
WINDOWS = {1: 1, 4: 2, 16: 8}
MAX_TEMPLATES = 2000

# Licence, template. Notices and the first paragraphs of licence texts, in public use.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights"),
]


def _words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _places(n: Column, width: int, step: int = 1) -> Column:
    """Starts 0, step, ... of the windows of ``width`` in ``n`` things; none if there are fewer."""
    return F.when(n >= width, F.sequence(F.lit(0), n - width, F.lit(step))).otherwise(F.array().cast("array<int>"))


def _shingle_hashes(words: Column) -> Column:
    return F.transform(
        _places(F.size(words), SHINGLE), lambda i: F.xxhash64(*[words[i + k] for k in range(SHINGLE)])
    )


def _shingles(words: Column) -> Column:
    return F.array_distinct(
        F.transform(_places(F.size(words), SHINGLE), lambda i: F.concat_ws(" ", *[words[i + k] for k in range(SHINGLE)]))
    )


def _rehashed(hashes: Column, band: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))


def _looked_up(minima: Column, values: dict[int, list[int]]) -> Column:
    """Templates of all minima that the index has."""
    of = _map(values, "map<bigint,array<int>>")
    known = F.filter(minima, lambda m: m.isin(list(values)))
    return F.flatten(F.transform(known, lambda m: of[m]))


def _minima(hashes: Column, width: int, step: int) -> Column:
    """Smallest of the hashes in each window."""
    if width == 1:
        return hashes
    # element by element: a slice would copy the whole array each time
    return F.transform(
        _places(F.size(hashes), width, step), lambda i: F.least(*[hashes[i + k] for k in range(width)])
    )


def _signed(df: DataFrame, steps: dict[int, int]) -> DataFrame:
    """``df`` (with ``words``) with the minima of each window size in each band.

    Single shingles need no bands, since a window of one is its own minimum under any hash.
    """
    df = df.withColumn("band_0", _shingle_hashes(F.col("words")))
    df = df.withColumns({f"band_{b}": _rehashed(F.col("band_0"), b) for b in range(1, BANDS)})
    return df.withColumns(
        {
            f"minima_{width}_{b}": _minima(F.col(f"band_{b}"), width, step)
            for width, step in steps.items()
            for b in range(BANDS if width > 1 else 1)
        }
    )


def _index(spark: SparkSession, templates: list[tuple[str, str]]):
    """Shingles of each template; templates by window size, band and value."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError("so many templates do not belong in a plan; split them and take the union of the results")
    listed = F.array(*[F.struct(F.lit(i).alias("number"), F.lit(t).alias("text")) for i, (_, t) in enumerate(templates)])
    df = spark.range(1).select(F.explode(listed).alias("t")).select("t.*").withColumn("words", _words(F.col("text")))
    rows = _signed(df, dict.fromkeys(WINDOWS, 1)).withColumn("shingles", _shingles(F.col("words"))).collect()
    shingles, found = {}, {}
    for r in rows:
        n = len(r["band_0"])
        if not n:
            raise ValueError(f"a template needs {SHINGLE} words: {r['text']!r}")
        shingles[r["number"]] = r["shingles"]
        width = max(w for w, step in WINDOWS.items() if w + step - 1 <= n)
        for b in range(BANDS if width > 1 else 1):
            for value in set(r[f"minima_{width}_{b}"]):
                found.setdefault((width, b), {}).setdefault(value, []).append(r["number"])
    return shingles, found


def _map(entries: dict, kind: str) -> Column:
    pairs = [x for k, v in entries.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return F.create_map(*pairs).cast(kind)


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """Licences named or quoted in every row's text.

    Columns: ``doc_id``, ``licenses`` (distinct, ascending), ``n_templates``, ``best`` (highest
    containment, 0 if nothing matches) and ``matches`` (array of template number, licence and
    containment). A template matches if at least ``containment`` of its distinct five-word shingles are
    in the text. Null and short texts match nothing; rows are only ever added columns to, so null ids
    and repeated rows stay; other columns are ignored. One pass without a shuffle: templates are a
    bounded list that stands in the plan.
    """
    templates = TEMPLATES if templates is None else templates
    shingles, index = _index(docs.sparkSession, templates)
    source = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).alias("text"))
    df = source.select("doc_id", _words(F.coalesce("text", F.lit(""))).alias("words"))
    df = _signed(df, WINDOWS)
    hits = [_looked_up(F.col(f"minima_{width}_{band}"), values) for (width, band), values in index.items()]
    df = df.select("doc_id", "words", F.array_distinct(F.concat(*hits)).alias("candidates"))
    text = F.when(F.size("candidates") > 0, _shingles(F.col("words")))
    df = df.select("doc_id", "candidates", text.alias("shingles"))
    of = _map(shingles, "map<int,array<string>>")
    share = F.transform(
        "candidates",
        lambda t: F.struct(
            t.alias("template"),
            F.array(*[F.lit(name) for name, _ in templates])[t].alias("license"),
            (F.size(F.array_intersect(of[t], F.col("shingles"))) / F.size(of[t])).alias("containment"),
        ),
    )
    matches = F.array_sort(F.filter(share, lambda m: m["containment"] >= containment))
    # a generator: a caller's filter on the result must not be moved below, where it would be computed
    # with all of the above once for every word
    df = df.select("doc_id", F.explode(F.array(matches)).alias("matches"))
    return df.select(
        "doc_id",
        F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))).alias("licenses"),
        F.size("matches").cast("long").alias("n_templates"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("best"),
        "matches",
    )
