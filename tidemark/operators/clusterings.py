"""K-means for several numbers of clusters at once: every scan moves the centres of all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.caching import spread
from tidemark.operators.models import SEED

# Centres start from at most this many rows, those of the smallest hashes; all rows move them.
START_ROWS = 4_000
TRIALS = 5
STEPS, TOLERANCE = 20, 1e-4


def _assigned(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, of equal ones the first, and the squared distance."""
    squares = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)[None, :]
    nearest = squares.argmin(axis=1)
    return nearest, np.maximum(squares[np.arange(len(x)), nearest], 0.0)


def _starts(x: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """The best of some trials on a sample: rows far from the centres so far (k-means++), then a few steps."""
    best = None
    for _ in range(TRIALS):
        centres = x[[draw.integers(len(x))]]
        for _ in range(1, k):
            _, away = _assigned(x, centres)
            if away.sum() <= 0:
                break  # fewer different rows than clusters
            centres = np.vstack([centres, x[draw.choice(len(x), p=away / away.sum())]])
        for _ in range(5):
            own, away = _assigned(x, centres)
            centres = np.stack([x[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))])
        cost = _assigned(x, centres)[1].sum()
        if best is None or cost < best[0]:
            best = (cost, centres)
    return best[1]


def _scan(vectors: DataFrame, centres: list[np.ndarray], shift: np.ndarray) -> list[np.ndarray]:
    """Per clustering and cluster the number of rows, their sum, their squares and their squared distances."""
    width = len(shift)
    firsts = np.cumsum([0, *map(len, centres)])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((firsts[-1], width + 3))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            squares = (x * x).sum(axis=1)
            for first, own in zip(firsts, centres, strict=False):
                nearest, away = _assigned(x, own)
                hit = np.zeros((len(own), len(x)))
                hit[nearest, np.arange(len(x))] = 1.0
                total[first : first + len(own)] += hit @ np.column_stack([x, np.ones(len(x)), squares, away])
        yield _rows(total)

    return _collected(vectors, sums, firsts, width + 3)


def _rows(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(total)), type=pa.int32()), pa.array(list(total), type=pa.list_(pa.float64()))], ["row", "sums"]
    )


def _collected(vectors: DataFrame, sums, firsts: np.ndarray, width: int) -> list[np.ndarray]:
    """The arrays of all tasks, summed on the cluster by cluster of rows; a row a cluster comes to the driver."""
    pieces = vectors.mapInArrow(sums, "row int, sums array<double>")
    each = pieces.select("row", F.posexplode("sums").alias("place", "v")).groupBy("row", "place").agg(F.sum("v").alias("v"))
    whole = np.zeros((firsts[-1], width))
    for r in each.collect():
        whole[r["row"], r["place"]] = r["v"]
    return [whole[a:b] for a, b in zip(firsts[:-1], firsts[1:], strict=True)]


def _silhouettes(vectors: DataFrame, centres: list[np.ndarray], found: list[np.ndarray], shift: np.ndarray) -> list[float]:
    """Mean silhouettes with squared Euclidean distance, from the sums of the clusters."""
    width = len(shift)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), 2))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            squares, at = (x * x).sum(axis=1), np.arange(len(x))
            for i, (own, stats) in enumerate(zip(centres, found, strict=True)):
                nearest, _ = _assigned(x, own)
                n = stats[:, width]
                away = squares[:, None] * n + stats[:, width + 1] - 2 * x @ stats[:, :width].T  # to all rows of a cluster
                inside = away[at, nearest] / np.maximum(n[nearest] - 1, 1)
                others = np.where(n > 0, away / np.maximum(n, 1), np.inf)
                others[at, nearest] = np.inf
                outside = others.min(axis=1)
                largest = np.maximum(inside, outside)
                lonely = (n[nearest] <= 1) | ~np.isfinite(outside) | (largest <= 0)
                score = np.where(lonely, 0.0, (outside - inside) / np.where(lonely, 1.0, largest))
                total[i] += score.sum(), len(x)
        yield _rows(total)

    each = _collected(vectors, sums, np.arange(len(centres) + 1), 2)
    return [float(s[0, 0] / s[0, 1]) for s in each]


def kmeans_sweep(
    df: DataFrame, ks: Sequence[int] = range(2, 8), features: str = "features", seed: int = SEED
) -> DataFrame:
    """``k, sse, silhouette, cluster, size``: a row per cluster for every number of clusters.

    The clusterings share their scans: one to choose starting rows, one a step for the centres of all of them that still
    move, one for sizes and errors, and one for the silhouettes. Clusters are numbered by size, the largest
    first. Where there are fewer different rows than clusters, or a cluster loses its last row, there are fewer.
    """
    rows = []
    with spread(df.select(vector_to_array(F.col(features)).alias("x")).where("x IS NOT NULL")) as vectors:
        sample = vectors.orderBy(F.xxhash64("x")).limit(START_ROWS).toArrow()["x"].to_pylist()
        if not sample:
            raise ValueError("no rows to cluster")
        start = np.array(sample, dtype=float)
        shift = start.mean(axis=0)
        draw = np.random.default_rng(seed)
        centres = [_starts(start - shift, k, draw) for k in ks]
        moving = list(range(len(centres)))
        for _ in range(STEPS):
            found = _scan(vectors, [centres[i] for i in moving], shift)
            after = []
            for i, stats in zip(moving, found, strict=True):
                n = stats[:, -3:-2]
                moved = np.where(n > 0, stats[:, :-3] / np.maximum(n, 1), centres[i])
                if ((moved - centres[i]) ** 2).sum(axis=1).max() > TOLERANCE**2:
                    after.append(i)
                centres[i] = moved
            moving = after
            if not moving:
                break
        found = _scan(vectors, centres, shift)
        scores = _silhouettes(vectors, centres, found, shift)
        for k, stats, score in zip(ks, found, scores, strict=True):
            cost = float(stats[:, -1].sum())
            sizes = sorted((int(n) for n in stats[:, -3] if n > 0), reverse=True)
            rows += [(k, cost, score, c, n) for c, n in enumerate(sizes)]
    return df.sparkSession.createDataFrame(rows, "k int, sse double, silhouette double, cluster int, size bigint")
