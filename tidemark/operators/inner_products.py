"""The items with the largest inner products for every user, without comparing all pairs.

Items come in blocks by falling norm. The product of a user with any item of a block is at most the user's norm
times the largest norm in it (Cauchy-Schwarz), so a user is done as soon as the k-th best product is not below that. Items that a
user has seen are masked in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranks import with_rank
from tidemark.session import shared_folder

# Size of the factors that every worker holds at a time; more items take several passes.
BLOCK_BYTES = 32 << 20
# Items that a batch of users is compared with before the bound is tried again.
STEP = 2048
# Tasks a core that users are dealt among, so that the last ones do not wait long for one.
TASKS_PER_CORE = 4
# Products a user, in multiples of k, that are kept from a step without looking for its k largest first.
_HITS = 4
# Numbers of products in a step, which bounds the users taken at a time.
_PRODUCTS = 1 << 22


def _best(
    vectors: np.ndarray, held: tuple, items: tuple, seen: tuple[np.ndarray, np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(user, item, product) of the ``k`` best of ``held`` (the same three) and of a block of ``items``.

    ``items`` are numbers, factors and norms by falling norm; ``seen`` are users and the places of items.
    """
    numbers, factors, norms = items
    user, item, product = held
    own = np.linalg.norm(vectors, axis=1)
    by_place = np.argsort(seen[1], kind="stable")
    seen_user, seen_place = seen[0][by_place], seen[1][by_place]
    worst = _worst(user, product, len(vectors), k)
    for start in range(0, len(numbers), STEP):
        # a hair more than the bound, for the rounding of products
        active = np.flatnonzero(own * norms[start] * (1 + 1e-5) >= worst)
        if not len(active):
            break
        stop = min(start + STEP, len(numbers))
        products = vectors[active] @ factors[start:stop].T
        low, high = np.searchsorted(seen_place, [start, stop])
        if low < high:
            where = np.full(len(vectors), -1)
            where[active] = np.arange(len(active))
            rows = where[seen_user[low:high]]
            products[rows[rows >= 0], seen_place[low:high][rows >= 0] - start] = -np.inf
        # few products reach the k-th best so far; one comparison each finds them
        least = np.maximum(worst[active], np.finfo(np.float32).min).astype(np.float32)  # exact: it is such a product
        hits = np.flatnonzero(products >= least[:, None])
        if len(hits) > _HITS * k * len(active) and stop - start > k:
            # of each user's products only those among the k largest of this step can count
            largest = np.partition(products, stop - start - k, axis=1)[:, stop - start - k]
            hits = np.flatnonzero(products >= np.maximum(least, largest)[:, None])
        if not len(hits):
            continue
        x, y = np.divmod(hits, stop - start)
        user = np.concatenate([user, active[x]])
        item = np.concatenate([item, numbers[start:stop][y]])
        product = np.concatenate([product, products[x, y]])
        order = np.lexsort((item, -product, user))
        user, item, product = user[order], item[order], product[order]
        first = np.searchsorted(user, np.arange(len(vectors)))
        keep = np.arange(len(user)) - first[user] < k
        user, item, product = user[keep], item[keep], product[keep]
        worst = _worst(user, product, len(vectors), k)
    return user, item, product


def _worst(user: np.ndarray, product: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th best product of each user, or minus infinity; users come in order, their products falling."""
    counts = np.bincount(user, minlength=n)
    ends = np.cumsum(counts)
    worst = np.full(n, -np.inf)
    worst[counts >= k] = product[ends[counts >= k] - 1]
    return worst


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(lists), width)


def top_inner_products(
    users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``user, rank, item, rating``: the ``k`` items of the largest products for every one of ``users``.

    ``users`` and ``items`` have an int ``id`` and ``features`` (array of float); ``seen`` (``user, item``) is what no user
    is given again; it may name other users too, and where the rows of a user lie together, tasks pass on one list of them.
    Of equal products the smallest item wins. Users without ``k`` unseen items have fewer.

    Users are dealt evenly among the cores where items are more than a step. Workers hold ``block_bytes`` of factors at
    a time. Where items are more, the users who are not done by the
    bound go on to the next block, and passes end when there are none.
    """
    spark = users.sparkSession
    asked = users.select(F.col("id").cast("int").alias("user"), "features")
    if seen is not None:
        listed = seen.groupBy("user").agg(F.collect_set(F.col("item").cast("int")).alias("seen"))
        asked = asked.join(listed, "user", "left")
    else:
        asked = asked.withColumn("seen", F.lit(None).cast("array<int>"))
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    sized = items.select(F.col("id").cast("int").alias("item"), "features", norm.alias("norm"))
    number, width = sized.agg(F.count("*"), F.max(F.size("features"))).first()
    if not number:
        return spark.createDataFrame([], "user int, rank int, item int, rating float")
    block = max(1, block_bytes // (4 * width + 16))
    if number > STEP:
        # a user's work is with the items, so small partitions that reading would join stay apart
        asked = asked.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, "user")
    kinds = "user int, features array<float>, seen array<int>, items array<int>, ratings array<float>, open boolean"
    waiting = asked.withColumn("items", F.array().cast("array<int>")).withColumn("ratings", F.array().cast("array<float>"))
    if number <= block:
        found = _pass(waiting, sized.orderBy(F.desc("norm"), "item"), k, width, None, kinds)
        return _flat(found)
    ranked = with_rank(sized, F.desc("norm"), F.asc("item"), name="place")
    done = []
    for start in range(0, number, block):
        part = ranked.where((F.col("place") >= start) & (F.col("place") < start + block)).orderBy("place")
        following = ranked.where(F.col("place") == start + block).select("norm").first()
        folder = shared_folder(spark, "top-items")
        _pass(waiting, part, k, width, following[0] if following else None, kinds).write.parquet(folder)
        found = spark.read.parquet(folder)
        done.append(found.where("NOT open"))
        waiting = found.where("open").drop("open")
        if following is None or waiting.isEmpty():
            break
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return _flat(result)


def _pass(waiting: DataFrame, part: DataFrame, k: int, width: int, following: float | None, kinds: str) -> DataFrame:
    """``waiting`` after one block of items, with whether items to come may still be better: ``open``.

    ``following`` is the largest norm of those. Users who are done leave their factors and seen items behind.
    """
    table = part.select("item", "features", "norm").toArrow().combine_chunks()  # a block of bounded size
    numbers = table["item"].to_numpy()
    factors = _matrix(table["features"].combine_chunks(), width)
    norms = table["norm"].to_numpy()
    shared = waiting.sparkSession.sparkContext.broadcast((numbers, factors, norms))
    schema = pa.schema(
        [("user", pa.int32()), ("features", pa.list_(pa.float32())), ("seen", pa.list_(pa.int32())),
         ("items", pa.list_(pa.int32())), ("ratings", pa.list_(pa.float32())), ("open", pa.bool_())]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, factors, norms = shared.value
        by_number = np.argsort(numbers)
        in_order = numbers[by_number]
        size = max(1, _PRODUCTS // min(STEP, len(numbers)))
        for whole in batches:
            for at in range(0, whole.num_rows, size):
                batch = whole.slice(at, size)
                vectors = _matrix(batch.column("features"), width)
                parents = batch.column("items").value_parent_indices().to_numpy(zero_copy_only=False)
                held = (
                    parents,
                    batch.column("items").flatten().to_numpy(zero_copy_only=False),
                    batch.column("ratings").flatten().to_numpy(zero_copy_only=False),
                )
                known = batch.column("seen").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                who = batch.column("seen").value_parent_indices().to_numpy(zero_copy_only=False)
                place = np.minimum(np.searchsorted(in_order, known), len(in_order) - 1)
                here = in_order[place] == known
                user, item, product = _best(
                    vectors, held, (numbers, factors, norms), (who[here], by_number[place[here]]), k
                )
                n = batch.num_rows
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(user, minlength=n))]), type=pa.int32())
                if following is None:
                    open_ = np.zeros(n, dtype=bool)
                else:
                    limit = np.linalg.norm(vectors, axis=1) * following * (1 + 1e-5)
                    open_ = limit >= _worst(user, product, n, k)
                going_on = pa.array(np.arange(n), mask=~open_)
                columns = [
                    batch.column("user"),
                    *(batch.column(c).take(going_on) for c in ("features", "seen")),
                    pa.ListArray.from_arrays(offsets, pa.array(item, type=pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(product.astype(np.float32))),
                    pa.array(open_),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return waiting.mapInArrow(compare, kinds)


def _flat(found: DataFrame) -> DataFrame:
    best = F.posexplode(F.arrays_zip("items", "ratings")).alias("_place", "_best")
    return found.select("user", best).select(
        "user", (F.col("_place") + 1).alias("rank"), F.col("_best.items").alias("item"), F.col("_best.ratings").alias("rating")
    )
