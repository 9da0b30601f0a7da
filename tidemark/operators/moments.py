"""Sums of products of columns in one pass: wide correlations, and linear models for a whole grid of penalties.

Tasks multiply blocks of rows as matrices and send one matrix each, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.models import Search

# Widest vectors whose products are summed as one matrix.
MOST_FEATURES = 2000
# Rows whose mean numbers are shifted by, so that sums of squares keep their digits; any shift gives the same result.
SHIFT_ROWS = 1000


def _sums_of_rows(pieces: DataFrame, key: str, names: Sequence[str], kinds: str) -> DataFrame:
    """Element-wise sums of array columns per ``key``; a group has an array a task."""

    def add(group: pa.Table) -> pa.Table:
        first = group[key][0].as_py()
        sums = [np.sum(np.stack([np.asarray(v.as_py()) for v in group[n]]), axis=0) for n in names]
        lists = {n: pa.array([s], type=pa.list_(pa.float64())) for n, s in zip(names, sums, strict=True)}
        return pa.table({key: pa.array([first], type=pa.int32()), **lists})

    return pieces.groupBy(key).applyInArrow(add, f"{key} int, {kinds}")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in both orders: ``col_a, col_b, corr``.

    For hundreds of columns: one pass, in which each task sums the products of all columns. A pair is judged by the
    rows where both values are known; it has no correlation if one of them does not vary there.
    """
    width, names = len(columns), ["both", "sums", "sums_b", "squares", "squares_b", "products"]
    shift = df.select(*columns).limit(SHIFT_ROWS).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    centre = np.array([0.0 if v is None else v for v in shift])
    numbers = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    kinds = ", ".join(f"{n} array<double>" for n in names)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), width, width))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - centre
            known = ~np.isnan(x)
            x, known = np.where(known, x, 0.0), known.astype(np.float64)
            sums, squares = x.T @ known, (x * x).T @ known
            total += np.stack([known.T @ known, sums, sums.T, squares, squares.T, x.T @ x])
        for a in range(width):
            parts = [pa.array([t[a]], type=pa.list_(pa.float64())) for t in total]
            yield pa.RecordBatch.from_arrays([pa.array([a], type=pa.int32()), *parts], ["a", *names])

    sums = _sums_of_rows(numbers.mapInArrow(multiply, f"a int, {kinds}"), "a", names, kinds)
    pairs = sums.select("a", F.posexplode(F.arrays_zip(*names)).alias("b", "s")).select("a", "b", "s.*")
    n = F.col("both")
    spread_a = F.col("squares") - F.col("sums") * F.col("sums") / n
    spread_b = F.col("squares_b") - F.col("sums_b") * F.col("sums_b") / n
    common = F.col("products") - F.col("sums") * F.col("sums_b") / n
    corr = F.when((n > 1) & (spread_a > 0) & (spread_b > 0), common / F.sqrt(spread_a * spread_b))
    labels = F.array(*[F.lit(c) for c in columns])
    return pairs.select(F.get(labels, "a").alias("col_a"), F.get(labels, "b").alias("col_b"), corr.alias("corr"))


@dataclass
class Moments:
    """Sums over rows of features and label, both shifted: number, sums, and sums of products (the label last)."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products, self.shift)

    @property
    def means(self) -> np.ndarray:
        return self.sums / self.n + self.shift

    @property
    def covariances(self) -> np.ndarray:
        mean = self.sums / self.n
        return self.products / self.n - np.outer(mean, mean)

    def r2(self, weights: np.ndarray, intercept: float) -> float:
        """Share of the label's variance that a linear model explains on these rows."""
        covariances, means = self.covariances, self.means
        bias = means[-1] - intercept - weights @ means[:-1]
        error = covariances[-1, -1] - 2 * weights @ covariances[:-1, -1] + weights @ covariances[:-1, :-1] @ weights
        return float(1 - (error + bias * bias) / covariances[-1, -1])


def moments(df: DataFrame, label: str, features: str, part: str) -> dict[bool, Moments]:
    """The moments of the rows where ``part`` is false and of those where it is true, from one pass.

    A matrix a task and part is summed row by row of the matrix on the cluster; the sums, of bounded size, come
    to the driver. Rows without a label or with unknown numbers are left out.
    """
    numbers = df.select(
        F.concat(vector_to_array(F.col(features)), F.array(F.col(label).cast("double"))).alias("x"), F.col(part).alias("part")
    )
    first = [np.array(r.x, dtype=float) for r in numbers.select("x").limit(SHIFT_ROWS).collect()]
    first = [x for x in first if np.isfinite(x).all()]
    if not first:
        raise ValueError("no rows with a label and known features to fit")
    shift, width = np.mean(first, axis=0), len(first[0])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width + 1, width + 1))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            judged = batch.column("part").to_numpy(zero_copy_only=False)
            known = np.isfinite(x).all(axis=1)
            x = np.column_stack([x, np.ones(len(x))])
            for k in (0, 1):
                rows = x[known & (judged == bool(k))]
                total[k] += rows.T @ rows
        flat = total.reshape(2 * (width + 1), width + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(flat)), type=pa.int32()), pa.array(list(flat), type=pa.list_(pa.float64()))], ["row", "sums"]
        )

    pieces = numbers.mapInArrow(multiply, "row int, sums array<double>")
    rows = _sums_of_rows(pieces, "row", ["sums"], "sums array<double>").collect()
    whole = np.zeros((2 * (width + 1), width + 1))
    for r in rows:
        whole[r.row] = r.sums
    found = {}
    for k, matrix in enumerate(whole.reshape(2, width + 1, width + 1)):
        found[bool(k)] = Moments(matrix[-1, -1], matrix[:-1, -1], matrix[:-1, :-1], shift)
    return found


def elastic_net(found: Moments, penalty: float, mixing: float, tolerance: float = 1e-12, sweeps: int = 20_000) -> tuple[np.ndarray, float]:
    """Weights and intercept of least squares with an elastic-net penalty, as ``LinearRegression`` defines it.

    Features and label count in units of their standard deviations; those that do not vary get no weight. Ridge
    has a closed form; with an absolute part the coordinates descend one after the other.
    """
    covariances, means = found.covariances, found.means
    deviation = np.sqrt(np.maximum(np.diag(covariances), 0.0))
    scale = np.maximum(np.abs(means - found.shift), np.abs(found.shift)) * 1e-10
    use = np.flatnonzero(deviation[:-1] > scale[:-1])
    weights = np.zeros(len(means) - 1)
    spread = deviation[-1]
    if spread > scale[-1] and len(use):
        gram = covariances[np.ix_(use, use)] / np.outer(deviation[use], deviation[use])
        target = covariances[use, -1] / deviation[use] / spread
        square, absolute = (1 - mixing) * penalty / spread, mixing * penalty / spread
        if absolute == 0:
            ridge = gram + square * np.eye(len(use))
            scaled = np.linalg.solve(ridge, target) if square else np.linalg.lstsq(ridge, target, rcond=None)[0]
        else:
            scaled = _descended(gram, target, square, absolute, tolerance, sweeps)
        weights[use] = scaled * spread / deviation[use]
    return weights, float(means[-1] - weights @ means[:-1])


def _descended(gram: np.ndarray, target: np.ndarray, square: float, absolute: float, tolerance: float, sweeps: int) -> np.ndarray:
    """Coordinate descent, with the equations of the coordinates in use solved whenever their signs have settled."""
    at, signs = np.zeros(len(target)), None
    diagonal = np.diag(gram)
    for sweep in range(sweeps):
        largest = 0.0
        for j in range(len(at)):
            free = target[j] - gram[j] @ at + diagonal[j] * at[j]
            value = np.sign(free) * max(abs(free) - absolute, 0.0) / (diagonal[j] + square)
            largest, at[j] = max(largest, abs(value - at[j])), value
        if largest <= tolerance:
            break
        now = np.sign(at)
        if sweep % 10 == 9 and signs is not None and np.array_equal(now, signs):
            used = np.flatnonzero(now)
            solved = np.zeros(len(at))
            system = gram[np.ix_(used, used)] + square * np.eye(len(used))
            solved[used] = np.linalg.lstsq(system, target[used] - absolute * now[used], rcond=None)[0]
            slack = target - gram @ solved - square * solved
            fits = np.all(np.abs(slack[now == 0]) <= absolute + 1e-12) and np.array_equal(np.sign(solved), now)
            if fits and np.allclose(slack[used], absolute * now[used], atol=1e-10):
                return solved
        if sweep % 10 == 9:
            signs = now
    return at


def search_by_moments(regression: LinearRegression, grid: list, data: DataFrame, validation: str) -> Search:
    """The whole grid of ``regParam`` and ``elasticNetParam`` from one pass over ``data``.

    Candidates are fitted to the moments of the rows where ``validation`` is false and judged by R² from those of
    the others; the first of the best is fitted to both. Metrics, choice and model are those of a search that fits
    every candidate on the rows.
    """
    found = moments(data, regression.getLabelCol(), regression.getFeaturesCol(), validation)
    named = [{p.name: float(v) for p, v in params.items()} for params in grid]
    settings = [
        (p.get("regParam", regression.getRegParam()), p.get("elasticNetParam", regression.getElasticNetParam())) for p in named
    ]
    metrics = [found[True].r2(*elastic_net(found[False], *s)) if found[True].n else float("nan") for s in settings]
    chosen = int(np.nanargmax(metrics)) if found[True].n else 0
    best = linear_model(regression.copy(grid[chosen]), *elastic_net(found[False] + found[True], *settings[chosen]))
    return Search(best, grid, metrics, chosen)


def linear_model(regression: LinearRegression, weights: np.ndarray, intercept: float) -> LinearRegressionModel:
    """A fitted model of ``pyspark.ml`` with these weights. It can be evaluated and stored like others, but has no
    ``summary`` of a training run."""
    context = SparkContext._active_spark_context
    java = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        regression.uid, _py2java(context, Vectors.dense(weights)), intercept, 1.0
    )
    return regression._copyValues(LinearRegressionModel(java))
